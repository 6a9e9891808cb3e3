"""Operators against plain re-statements on small, awkward tables."""

import binascii
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sessionloom.llm import (
    blocks,
    decontaminate,
    line_dedup,
    lm_scoring,
    near_dedup,
    packing,
    passage_dedup,
    prefix_free,
    quality_rules,
    secrets,
    sharding,
    substring_dedup,
    textscan,
)
from sessionloom.llm.common import ship
from sessionloom.llm.components import components
from sessionloom.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside must not disturb a table that has them.
CLASHING = (
    SCHEMA + ", row string, kept boolean, n_words string, key int, component_id int, spans int, "
    "toxic string, quality string, fit_id int, given_id int, text_a int, _text_a int"
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def prose(seed, n, vocabulary=3000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def corpus():
    """Nulls, blanks, copies, near copies, shared passages, long runs, ties, repeated rows."""
    base = [prose(i, 60 + i) for i in range(12)]
    passage = prose(99, 70)
    texts = [None, "", "   \n\t ", "one", "two words", *base]
    texts += [base[0], base[0], base[1].upper(), base[2] + " tail", "lead " + base[3]]
    texts += [prose(50 + i, 40) + "\n" + passage + "\n" + prose(70 + i, 40) for i in range(5)]
    texts += ["a" * 900, "b" * 450 + "a" * 450, "ab " * 300, "x " * 30, "é" * 300 + passage]
    texts += [prose(7, 4000), "Grüße 東京 " * 40, "\x00\x01 " + base[5]]
    texts += [f"{base[6]} {i}" for i in range(6)]
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, None) for i, t in enumerate(texts)]
    rows += [(None, base[0], "en", "s", None), (None, None, None, None, None), rows[5], rows[5]]
    return rows


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def clashing(spark, rows):
    return table(spark, [(*r, "r", True, "n", 1, 2, 3, "t", "q", 4, 5, 6, 7) for r in rows], CLASHING)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark, corpus()).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


# Shared scans ------------------------------------------------------------------------------


def test_words_and_hashes_do_not_depend_on_place():
    texts = [b" a  bb\n", b"", b"bb a", b"\x0b\x0c", b"ccc"]
    words = textscan.Words(texts)
    found = [bytes(words.data[a:b]) for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == [b"a", b"bb", b"bb", b"a", b"ccc"]
    assert words.doc.tolist() == [0, 0, 2, 2, 4]
    hashes = textscan.range_hash(textscan.prefix_hash(words.data), words.starts, words.ends)
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] and len(set(hashes.tolist())) == 3


def test_equal_ranges():
    r = random.Random(1)
    body = bytes(r.choice(b"ab") for _ in range(400))
    pairs = [(r.randrange(300), r.randrange(300), r.randrange(0, 40)) for _ in range(3000)]
    a, b, n = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
    equal = textscan.equal_ranges(np.frombuffer(body, np.uint8), a, b, n)
    assert equal.tolist() == [body[x : x + k] == body[y : y + k] for x, y, k in pairs]


@pytest.mark.parametrize("seed", range(6))
def test_corpus_order_finds_every_repeat(seed):
    r = random.Random(seed)
    span = 30
    stock = [bytes(r.choice(b"abc\x00\xc3\xa9") for _ in range(90)) for _ in range(3)]
    strings = [
        b"".join(r.choice([s[r.randrange(40) :], b"a" * r.randrange(60), bytes([r.randrange(97, 123)])]) for s in stock)
        + b"z" * span
        for _ in range(12)
    ]
    strings = list(dict.fromkeys(strings))
    at = [s[i : i + span] for s in strings for i in range(len(s) - span + 1)]
    counts = collections.Counter(at)
    assert prefix_free.repeated(strings, span).tolist() == [counts[x] > 1 for x in at]


def test_suffix_ranks():
    text = b"banana$bananas$an$ana$"
    ends = []
    for part in text.split(b"$")[:-1]:
        ends += [len(ends) + len(part)] * len(part)
    plain = np.frombuffer(text.replace(b"$", b""), np.uint8)
    ranks = prefix_free._dictionary_ranks(plain, np.array(ends), 100)
    suffixes = [plain[i:e].tobytes() for i, e in enumerate(ends)]
    assert ranks.tolist() == [sum(t < s for t in suffixes) for s in suffixes]


# Line dedup --------------------------------------------------------------------------------


def test_lines(spark, empty):
    boiler = "  All rights reserved "
    rows = [(i, f"page {i}\n{boiler}\n\n\nend {i}", "en", "h", 1) for i in range(30)]
    rows += [(100 + i, f"other {i}\nAll rights reserved", "en", "small", 1) for i in range(5)]
    rows += [(110 + i, f"two {i}\nAll rights reserved", "en", "smaller", 1) for i in range(2)]
    rows += [(200 + i, f"{boiler.strip()}\nmine {i}" if i == 0 else f"mine {i}", "en", None, 1) for i in range(40)]
    rows += [(300, None, "en", "h", 1), (301, "", "en", "h", 1), (302, boiler, "en", "h", 1)]
    found = line_dedup.drop_boilerplate(clashing(spark, [r for r in rows]))
    kept = {r[0]: tuple(r)[1:] for r in found.select("row.doc_id", "n_lines", "n_removed", "clean_text").collect()}
    assert kept[3] == (5, 1, "page 3\n\n\nend 3")
    # The floor is three pages with the line, whatever the size of the host.
    assert kept[100] == (2, 1, "other 0")
    assert kept[110] == (2, 0, "two 0\nAll rights reserved")
    # One page in 40 of the null host has the line: no boilerplate there.
    assert kept[200] == (2, 0, "All rights reserved\nmine 0")
    assert kept[300] == (0, 0, None) and kept[301] == (1, 0, "") and kept[302] == (1, 1, "")
    joined = line_dedup.drop_boilerplate(table(spark, rows), broadcast_bytes=0, salts=3)
    assert got(joined, "row.doc_id", "clean_text") == got(found, "row.doc_id", "clean_text")
    assert line_dedup.drop_boilerplate(empty).count() == 0


def test_copies_are_one_page(spark):
    """A text with many copies keeps its lines; what its host shares goes."""
    copied = "first line of the copied text\nsecond line of it"
    rows = [(i, f"page {i}\nfooter", "en", "h", 1) for i in range(89)]
    rows += [(100 + i, f"{copied}\nfooter", "en", "h", 1) for i in range(11)]
    rows += [(200 + i, copied, "en", "copies", 1) for i in range(300)]
    rows += [(600 + i, f"own {i}", "en", "copies", 1) for i in range(25)]
    docs = table(spark, rows)
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_boilerplate(spark, docs, "").collect()}
    assert left == {d: t.removesuffix("\nfooter") for d, t, *_ in rows}


def test_powers_do_not_depend_on_the_length():
    low = textscan.LOW
    data = np.frombuffer(random.Random(3).randbytes(2 * low + 5000), np.uint8)
    sums = textscan.prefix_hash(data)
    a = np.array([0, 5, low - 450, low - 1, low, low + 1, 2 * low, 2 * low + 4000])
    far = textscan.range_hash(sums, a, a + 900)
    for place, value in zip(a.tolist(), far.tolist(), strict=True):
        near = textscan.prefix_hash(data[place : place + 900])
        assert textscan.range_hash(near, np.array([0]), np.array([len(near) - 1]))[0] == value


def test_covered_places():
    r = random.Random(4)
    for size in (1, 3, 50):
        starts = np.array([r.randrange(40) for _ in range(6)])
        want = [any(s <= i < s + size for s in starts) for i in range(40)]
        assert textscan.covered(starts, size, 40).tolist() == want


# Passage dedup -----------------------------------------------------------------------------


def plain_passages(rows, span):
    texts = [(t or "").encode() for _, t, *_ in rows]
    counts = collections.Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for (doc, *_), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if counts[t[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("span", [200, 60])
def test_passages(docs, span):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(passage_dedup.dedup(docs, span=span), *columns) == plain_passages(corpus(), span)


def test_passages_in_common(spark, monkeypatch):
    """A passage in every block is hot; its borders differ."""
    passage = prose(5, 60)
    rows = [(i, f"{prose(i, 9)} {passage} {prose(900 + i, 9)}", "", "", 0) for i in range(120)]
    monkeypatch.setattr(passage_dedup, "COMMON_BLOCKS", 2)
    df = table(spark, rows).repartition(12)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(passage_dedup.dedup(df), *columns) == plain_passages(rows, 200)


def test_passages_of_nothing(spark, empty):
    assert passage_dedup.dedup(empty).count() == 0
    blank = passage_dedup.dedup(table(spark, [(1, None, "", "", 0), (2, "", "", "", 0)]))
    assert got(blank, "doc_id", "n_bytes", "kept_text") == [(1, 0, ""), (2, 0, "")]
    with pytest.raises(ValueError):
        passage_dedup.dedup(empty, span=10)


# Packing -----------------------------------------------------------------------------------


def test_best_fit_takes_the_tightest():
    def plain(lengths, size):
        rooms, out = [], []
        for n in lengths:
            fits = [(room, i) for i, room in enumerate(rooms) if room >= n]
            i = min(fits)[1] if fits else len(rooms)
            if not fits:
                rooms.append(size)
            out.append(size - rooms[i])
            rooms[i] -= n
        return rooms, out

    r = random.Random(3)
    for size in (1, 2, 7, 64, 100):
        lengths = sorted((r.randint(1, size) for _ in range(300)), reverse=True)
        places = packing.best_fit(lengths, size)
        used = collections.Counter()
        for (sequence, offset), n in zip(places, lengths, strict=True):
            assert used[sequence] == offset
            used[sequence] += n
        assert max(used.values()) <= size
        assert len(used) == len(plain(lengths, size)[0])


def test_packing(docs, spark, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for doc, text, *_ in corpus():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want[doc, tuple(ids)] += 1
    pieces = packing.pack(docs, tokenizer_path(), with_ids=True, group_pieces=15).collect()
    seen = collections.defaultdict(list)
    for p in pieces:
        assert binascii.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"]
        assert p["length"] == len(p["ids"]) <= 2048
        seen[p["sequence_id"]].append((p["offset"], p["length"]))
    for places in seen.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    have = collections.Counter()
    by_doc = collections.defaultdict(dict)
    for p in pieces:
        key = p["doc_id"], p["doc_tokens"]
        copies = by_doc[key]
        copies.setdefault(p["start"], []).append(tuple(p["ids"]))
    for (doc, _), parts in by_doc.items():
        n = len(parts[0])
        texts = [()] * n
        for start in sorted(parts):
            # Equal ids and lengths: rows may be paired in any order that gives a document.
            texts = [t + s for t, s in zip(sorted(texts), sorted(parts[start]), strict=True)]
        have.update((doc, t) for t in texts)
    assert have == want
    whole = packing.sequences(packing.pack(docs, tokenizer_path(), with_ids=True)).collect()
    assert all(len(r["input_ids"]) == 2048 for r in whole)
    assert sum(r["n_tokens"] for r in whole) == sum(len(k[1]) * n for k, n in want.items())
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_other_tokenizers_encode_whole_texts():
    """The way by words is taken only for a file whose settings allow it."""
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["Two  words\n here", "", "Grüße, it's 12 o'clock", " x" * 50]
    other = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(other)
    found = packing.token_ids(texts, other)
    assert [list(f) for f in found] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert isinstance(packing._tokenizers[other], packing.TextTokenizer)
    packing.token_ids(texts, tokenizer_path())
    assert isinstance(packing._tokenizers[tokenizer_path()], packing.WordTokenizer)


# Near duplicates ---------------------------------------------------------------------------


def plain_components(rows, percent=85):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for doc, text, *_ in rows:
        w = WORD.findall((text or "").translate(lower))
        n = len(w)
        s = {tuple(w[i : i + 5]) for i in range(n - 4)} if n >= 5 else {tuple(w)} if w else set()
        sets.append((doc, s))
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (x, a) in enumerate(sets):
        for y, b in sets[:i]:
            if x is not None and y is not None and a and b:
                if 100 * len(a & b) >= percent * len(a | b):
                    parent[max(root(x), root(y))] = min(root(x), root(y))
    return sorted(
        ((d, len(s), None if d is None else root(d)) for d, s in sets), key=repr
    )


def test_near_duplicates(docs, empty):
    found = near_dedup.near_duplicates(docs)
    assert got(found, "doc_id", "n_shingles", "component_id") == plain_components(corpus())
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_in_a_drifting_group(spark):
    """Each text is an edit of one before; most pairs lie below the limit, links make chains."""
    r = random.Random(4)
    texts = [[f"t{r.randrange(10**6)}" for _ in range(90)]]
    for _ in range(70):
        words = list(r.choice(texts))
        for _ in range(r.choice([0, 1, 1, 2, 3])):
            words[r.randrange(len(words))] = f"t{r.randrange(10**6)}"
        texts.append(words)
    rows = [(i, " ".join(w), "", "", 0) for i, w in enumerate(texts)]
    r.shuffle(rows)
    found = near_dedup.near_duplicates(table(spark, rows))
    assert got(found, "doc_id", "n_shingles", "component_id") == plain_components(rows)


def test_sketch_estimates_similarity():
    r = random.Random(5)
    shared = [r.getrandbits(64) for _ in range(300)]
    for extra in (30, 100):
        sides = [shared + [r.getrandbits(64) for _ in range(extra)] for _ in range(2)]
        owner = np.repeat([0, 1], 300 + extra)
        hashes = np.array(sides[0] + sides[1], np.uint64)
        table = near_dedup.sketches(owner, hashes, 2, 2000)
        assert abs((table[0] == table[1]).mean() - 300 / (300 + 2 * extra)) < 0.06
    few = near_dedup.sketches(np.array([0, 0]), np.array([1, 2], np.uint64), 1, 352)
    assert (few != near_dedup._EMPTY).all()


def test_components(spark):
    r = random.Random(6)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    found = components(spark.createDataFrame(links, "a long, b long"))
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert dict(found.collect()) == {x: root(x) for x in parent if x not in loops}


# Decontamination ---------------------------------------------------------------------------


def plain_hits(rows, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    owners = collections.defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(lower))
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            owners[tuple(w[i : i + window])].add("null" if item is None else str(item))
    out = []
    for doc, text, *_ in rows:
        w = word.findall((text or "").translate(lower))
        hit, found = set(), set()
        for n in {len(k) for k in owners}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in owners:
                    hit |= set(range(i, i + n))
                    found |= owners[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def test_contamination(docs, spark, empty):
    body = dict((r[0], r[1]) for r in corpus()[:30])
    items = [(1, body[6]), (2, "W1 w2;w3"), (2, "W1 w2;w3"), (10, " ".join(body[9].split()[5:17]).upper())]
    items += [(None, body[12]), (4, None), (5, "!!"), (6, "x x")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = plain_hits(corpus(), items)
    for size in (1 << 20, 200):
        found = decontaminate.scan(docs, benchmark, automaton_bytes=size)
        assert got(found, "row.doc_id", "n_words", "n_hit", "item_ids") == want
    assert decontaminate.scan(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.scan(empty, benchmark).count() == 0
    text = "Ünï A, ONE two! three é ONE-two three"
    doc = table(spark, [(1, text, "", "", 0)])
    spans = decontaminate.scan(doc, spark.createDataFrame([(1, "one two three")], "item_id long, text string"))
    cut = [text[s["start"] : s["end"]] for s in spans.first()["spans"]]
    assert cut == ["ONE two! three", "ONE-two three"]


# Sharding ----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 4096, 5000])
def test_permutation_and_its_inverse(spark, n):
    rows = spark.range(n).withColumn("p", sharding.permuted("id", n)).withColumn("q", sharding.unpermuted("p", n))
    found = rows.collect()
    assert sorted(r["p"] for r in found) == list(range(n))
    assert all(r["q"] == r["id"] for r in found)
    if n >= 97:
        moved = np.array([r["p"] for r in found])
        assert abs(np.corrcoef(np.arange(n), moved)[0, 1]) < 0.35


def test_shards(docs, spark, empty):
    found = sharding.sharded(docs, 7)
    rows = found.collect()
    want = collections.Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in corpus()
    )
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.sharded(docs.repartition(5), 7)
    columns = ("doc_id", "size", "text_crc32", "shard", "slot")
    assert got(again, *columns) == got(found, *columns)
    assert sharding.sharded(empty, 7).count() == 0
    hot = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    parts = sharding.numbered(hot.select("doc_id", "text"), ["doc_id"], 8)
    assert sorted(r["number"] for r in parts.collect()) == list(range(5000))


# Secrets -----------------------------------------------------------------------------------


def plain_secrets(text):
    letters = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    out = []
    for m in re.finditer(letters + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def base62(number, size=6):
    out = ""
    while len(out) < size:
        number, digit = divmod(number, 62)
        out = secrets.BASE62[digit] + out
    return out


def test_base_secrets_match_plain_expressions():
    r = random.Random(8)
    parts = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "AKIA", "AKIAAKIA", "=", ":", " ", '"', "'",
             "abc123", "abc", "é", "ſecret", "toKen", "0123456789abcdef" * 2, "deadbeef", "ABCDEFGHIJKLMNOP1234", "\n", "x", "ghp_", "iban ", "card "]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(25)))
        found = [s for s in secrets.find(text) if s[0] in secrets.KINDS[:3]]
        assert found == plain_secrets(text), text


def test_checksums():
    body = "abcdefghij0123456789ABCDEFGHIJ"
    good = body + base62(zlib.crc32(body.encode()))
    assert secrets.find(f"ö ghp_{good} .") == [("github", 2, 42)]
    assert secrets.find(f"npm_{good}") == [("npm", 0, 40)]
    assert secrets.find(f"ghp_{good[:-1]}!") == [] and secrets.find(f"ghp_{body}000000") == []
    assert secrets.find("IBAN: DE89 3704 0044 0532 0130 00 end") == [("iban", 6, 33)]
    assert secrets.find("IBAN: DE88 3704 0044 0532 0130 00 end") == []
    assert secrets.find("card 4111 1111 1111 1111.") == [("card", 5, 24)]
    assert secrets.find("card 4111 1111 1111 1112.") == []
    assert secrets.find(None) == secrets.find("") == []


def test_numbers_among_other_words():
    def found(text):
        return [(kind, text[a:b]) for kind, a, b in secrets.find(text)]

    card, spain, belgium = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034"
    for text in (f"card {card} 12/26", f"visa card number ending soon: {card} 123", f"{card} (mastercard)",
                 f"mastercard, as printed there: {card}.", f"card 2 {card}"):
        assert found(text) == [("card", card)], text
    assert found("card 4111111111111111 123") == [("card", "4111111111111111")]
    assert found("card 371449635398431 1234") == [("card", "371449635398431")]
    assert found(f"IBAN {spain} EUR") == [("iban", spain)]
    assert found(f"IBAN {belgium} BIC") == [("iban", belgium)]
    assert found(f"{spain} EUR is the IBAN; pay to {belgium} X") == [("iban", spain), ("iban", belgium)]
    # Not the length of the country, a wrong checksum, too far from the word.
    assert found(f"IBAN {belgium}7") == [] and found("IBAN ES92 2100 0418 4502 0005 1332 EUR") == []
    assert found(f"card {'x' * 30} {card}") == [] and found(f"{card} {'x' * 30} card") == []


def test_secret_scan(docs, empty):
    found = secrets.scan(docs)
    assert found.count() == len(corpus())
    assert secrets.scan(empty).count() == 0


# Language model ----------------------------------------------------------------------------


def test_scores(docs, spark, empty):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [(d, WORD.findall((t or "").translate(lower)) + [None]) for d, t, *_ in corpus()]
    rest = {d: zlib.crc32(b"" if d is None else str(d).encode()) % 5 for d, _ in texts}
    counts = collections.Counter(w for d, words in texts if rest[d] != 1 for w in words)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (
            (d, rest[d] == 1, len(w), sum(counts[x] > 0 for x in w), n,
             round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6))
            for d, w in texts
        ),
        key=repr,
    )
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    found = lm_scoring.scored(docs)
    assert got(found, *columns, F.round("base_score", 6)) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in found.collect())
    assert lm_scoring.scored(empty).count() == 0


def test_model_learns_word_order(spark):
    """Held-out texts from a chain of words score far better than by word counts alone."""
    r = random.Random(9)
    follow = {f"v{i}": [f"v{r.randrange(40)}" for _ in range(2)] for i in range(40)}
    rows = []
    for i in range(300):
        word, out = "v0", []
        for _ in range(80):
            word = r.choice(follow[word])
            out.append(word)
        rows.append((i, " ".join(out), "", "", 0))
    found = lm_scoring.scored(table(spark, rows)).where("held_out").collect()
    tokens = sum(x["n_tokens"] for x in found)
    gain = sum(x["score"] - x["base_score"] for x in found) / tokens
    assert gain > 0.2


def brute_scores(texts, weights, statistics):
    """Log10 probability of each (id, words) by the model, in plain Python."""
    m64 = (1 << 64) - 1

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & m64
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & m64
        return x ^ (x >> 31)

    begin, end = int(lm_scoring._BEGIN), int(lm_scoring.END)
    one, two, skip = (int(x) for x in lm_scoring._PAIRS)
    words = sorted({w for _, ws in texts for w in ws})
    hashes = dict(zip(words, lm_scoring.word_hashes([w.encode() for w in words]).tolist(), strict=True)) | {None: end}
    kinds = {w: int(lm_scoring.classes_of(np.array([h], np.uint64), statistics.heads)[0]) for w, h in hashes.items()}
    train = [zlib.crc32(b"" if d is None else str(d).encode()) % 5 != 1 for d, _ in texts]
    counts = collections.Counter(w for (_, ws), t in zip(texts, train, strict=True) if t for w in ws)

    def row(h):
        return mixed(h ^ skip) % statistics.rows

    seen = collections.defaultdict(collections.Counter)
    for (_, ws), t in zip(texts, train, strict=True):
        for before, w in zip([begin, *[hashes[x] for x in ws]], ws):
            if t and kinds[w] > lm_scoring.HEADS:
                seen[row(before), kinds[w]][w] += 1
    share = {w: (counts[w] + 0.5) / statistics.word_total[kinds[w]] for w in words}
    pair = {}
    for key, group in seen.items():
        u = dict.fromkeys(group, 0.0)
        total = sum(group.values())
        for _ in range(lm_scoring.FIT_STEPS):
            room = 1 + sum(share[w] * math.expm1(u[w]) for w in group)
            p = {w: share[w] * math.exp(u[w]) / room for w in group}
            g = {w: n - total * p[w] - lm_scoring.PRIOR * u[w] for w, n in group.items()}
            d = {w: total * p[w] + lm_scoring.PRIOR for w in group}
            common = sum(p[w] * g[w] / d[w] for w in group) / (1 - sum(total * p[w] ** 2 / d[w] for w in group))
            for w in group:
                u[w] += min(1.5, max(-1.5, (g[w] + total * p[w] * common) / d[w]))
        pair[key] = u, math.log(1 + sum(share[w] * math.expm1(u[w]) for w in group))
    out = []
    for _, ws in texts:
        total = 0.0
        back = [begin, begin, begin]
        for w in [*ws, None]:
            x, y, z = back
            rows = [mixed(x), mixed(y ^ one), mixed((x * two + y) & m64), mixed((x * skip + z) & m64)]
            logits = statistics.prior.astype(float) + sum(weights[r % lm_scoring.ROWS].astype(float) for r in rows)
            logits -= logits.max()
            total += logits[kinds[w]] - math.log(np.exp(logits).sum())
            if kinds[w] > lm_scoring.HEADS:
                u, room = pair.get((row(x), kinds[w]), ({}, 0.0))
                total += math.log(share[w]) + u.get(w, 0.0) - room
            back = [hashes[w], x, y]
        out.append(total / math.log(10))
    return out


def test_scores_equal_the_model_in_plain_python(docs, spark, monkeypatch):
    made = []
    train = lm_scoring.trained
    monkeypatch.setattr(lm_scoring, "trained", lambda blocks, st: made.append((train(blocks, st), st)) or made[0][0])
    monkeypatch.setattr(lm_scoring, "PAIR_BUCKET_BYTES", 1 << 14)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [(d, WORD.findall((t or "").translate(lower))) for d, t, *_ in corpus()]
    found = got(lm_scoring.scored(docs), "doc_id", "score")
    want = sorted(zip([d for d, _ in texts], brute_scores(texts, *made[0]), strict=True), key=repr)
    key = lambda r: (r[0] is None, r[0] or 0, round(r[1], 2))
    for (a, x), (b, y) in zip(sorted(found, key=key), sorted(want, key=key), strict=True):
        assert a == b and x == pytest.approx(y, rel=1e-4, abs=1e-3)


def test_words_of_a_class_add_up_behind_any_word():
    """Over a whole class, words seen behind a row or not, and the room of unseen words."""
    r = np.random.default_rng(3)
    share = r.dirichlet(np.ones(50))
    seen = np.append(r.integers(0, 9, 20), np.zeros(30, np.int64))
    u, room = lm_scoring.fitted(share, seen, np.zeros(50, np.int64))
    assert np.sum(share * np.exp(u - room)) == pytest.approx(1)
    # At the optimum the prior holds what counts and expectations differ by.
    expected = seen.sum() * share * np.exp(u - room)
    assert np.allclose((seen - expected)[seen > 0], lm_scoring.PRIOR * u[seen > 0], atol=1e-3)
    assert (u[seen == 0] == 0).all()
    # Several groups at once are as each alone.
    two = lm_scoring.fitted(np.tile(share, 2), np.append(seen, seen[::-1]), np.repeat([3, 8], 50))
    assert np.allclose(two[0][:50], u) and np.allclose(two[1][:50], room)


def test_pair_weights_grow_with_the_words(spark, monkeypatch):
    """Pairs of far more words than the class factor has rows keep weights of their own, and
    held-out texts profit."""
    follow = [random.Random(i).sample(range(6000), 2) for i in range(6000)]
    r = random.Random(12)
    rows = []
    for i in range(600):
        word, out = r.randrange(6000), []
        for _ in range(300):
            word = follow[word][r.randrange(2)]
            out.append(word)
        rows.append((i, " ".join(f"v{w}" for w in out), "", "", 0))
    rows.append((None, None, "", "", 0))
    monkeypatch.setattr(lm_scoring, "WORD_BUCKET_BYTES", 1 << 18)
    monkeypatch.setattr(lm_scoring, "PAIR_BUCKET_BYTES", 1 << 18)
    found = lm_scoring.scored(table(spark, rows).repartition(3)).collect()
    for held in (True, False):
        some = [x for x in found if x["held_out"] == held]
        gain = sum(x["score"] - x["base_score"] for x in some) / sum(x["n_tokens"] for x in some)
        assert 1.0 < gain < 3.5


def test_class_probabilities_add_up():
    heads = np.sort(lm_scoring.word_hashes([b"a", b"b"]))
    kinds = lm_scoring.classes_of(np.append(heads, lm_scoring.END), heads)
    assert sorted(kinds.tolist()) == [0, 1, 2]
    weights = np.random.default_rng(1).normal(size=(lm_scoring.ROWS, lm_scoring.CLASSES)).astype(np.float32)
    prior = np.zeros(lm_scoring.CLASSES, np.float32)
    features = [np.array([1, 2]), np.array([3, 4])]
    odds = lm_scoring.class_probabilities(prior, weights, features)
    assert np.allclose(odds.sum(axis=1), 1, atol=1e-5)
    logs = lm_scoring.class_logs(prior, weights, features, np.array([5, 7]))
    assert np.allclose(np.exp(logs), odds[[0, 1], [5, 7]], atol=1e-6)


# Substring dedup ---------------------------------------------------------------------------


def plain_windows(rows, size=13):
    first = {}
    words = [(math.inf if d is None else d, WORD.findall(t or "")) for d, t, *_ in rows]
    for d, w in words:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, d), d)
    out = []
    for (d, w), row in zip(words, rows, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((row[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("buckets", [1 << 30, 500])
def test_windows(docs, buckets):
    found = substring_dedup.dedup(docs, bucket_bytes=buckets)
    assert got(found, "doc_id", "n_words", "n_removed", "kept_sha256") == plain_windows(corpus())


def test_windows_of_a_hot_passage(spark, empty, monkeypatch):
    passage = prose(5, 30)
    rows = [(i, f"{prose(i, 9)} {passage} {prose(900 + i, 9)}", "", "", 0) for i in range(150)]
    monkeypatch.setattr(substring_dedup, "HOT", 2)
    found = substring_dedup.dedup(table(spark, rows).repartition(6))
    assert got(found, "doc_id", "n_words", "n_removed", "kept_sha256") == plain_windows(rows)
    assert substring_dedup.dedup(empty).count() == 0


def test_windows_survive_equal_hashes():
    data = np.frombuffer(b"aa bb aa cc bb ", np.uint8)
    starts, sizes = np.array([0, 3, 6, 9, 12]), np.full(5, 2)
    least = substring_dedup.least_of_equal(data, starts, sizes, np.zeros(5, np.uint64), np.array([5, 4, 3, 2, 1]))
    assert least.tolist() == [3, 1, 3, 2, 1]


# Quality rules -----------------------------------------------------------------------------


def plain_quality(rows):
    out = []
    for d, t, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = set()
        for i in range(len(w) - 7):
            if c[tuple(w[i : i + 8])] > 1:
                hit |= set(range(i, i + 8))
        lines = [x for x in t.split("\n") if WORD.search(x)]
        out.append(
            (d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
             len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w))
        )
    return sorted(out, key=repr)


def test_quality_measures(docs, spark, empty):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality_rules.judged(docs, labels)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got(found, *columns) == plain_quality(corpus())
    # Nothing can be certified from these labels.
    assert found.where("kept = base_failed").count() == 0
    assert quality_rules.judged(empty, labels).count() == 0


@pytest.mark.parametrize("p", [0.01, 0.2])
def test_binomial_tail(spark, p):
    def plain(n, k):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    pairs = [(n, k) for n in (1, 2, 10, 300) for k in {0, 1, n // 3, n} if k <= n]
    rows = spark.createDataFrame(pairs, "n long, k long").withColumn("t", quality_rules.binomial_tail("n", "k", p))
    for r in rows.collect():
        assert r["t"] == pytest.approx(plain(r["n"], r["k"]), rel=1e-9)


def test_thresholds_reject_bad_texts_and_keep_good_ones(spark):
    r = random.Random(10)
    rows, labels = [], []
    for i in range(3000):
        words = prose(i, 40).split()
        bad = i % 5 == 0
        if bad:
            for _ in range(4):
                words[r.randrange(40)] = r.choice(["vile", "nasty", "rotten"])
        rows.append((i, " ".join(words), "en", "", 0))
        labels.append((i, 1, int(bad)))
    rows.append((9001, prose(1, 30) + " vile nasty rotten vile", "de", "", 0))
    rows.append((9002, prose(2, 30) + " vile nasty rotten vile", "en", "", 0))
    found = quality_rules.judged(
        table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    )
    kept = {x["doc_id"]: x["kept"] for x in found.collect()}
    good = [i for i in range(3000) if i % 5]
    assert sum(kept[i] for i in good) > 0.99 * len(good)
    assert sum(kept[i] for i in range(0, 3000, 5)) < 0.02 * 600
    # No label in that stratum: nothing is certified there.
    assert kept[9001] and not kept[9002]


def test_capitals_of_any_language_are_lowered(spark):
    rows = [(i, t, "de", "", 0) for i, t in enumerate(["über uns", "Über uns", "ÜBER über überall", "uber"])]
    found = quality_rules.measured(table(spark, rows), ["über"]).select("doc_id", "measures.abuse")
    assert got(found, "doc_id", "abuse") == [(0, 1.0), (1, 1.0), (2, 2.0), (3, 0.0)]


def test_levels_go_where_labels_can_certify(spark):
    """173 good texts certify beside strata that could certify nothing in any case."""
    counts = [("en", 173), ("de", 40), ("fr", 40), (None, 0)]
    rows = spark.createDataFrame(counts, "stratum string, n_good long")
    for name, value in quality_rules._levels(0.02, 0.05).items():
        rows = rows.withColumn(name, value)
    levels = {r["stratum"]: r["level"] for r in rows.collect()}
    assert levels["en"] == pytest.approx(0.05) and sum(levels.values()) == pytest.approx(0.05)
    rows = spark.createDataFrame([(str(i), 300) for i in range(4)], "stratum string, n_good long")
    for name, value in quality_rules._levels(0.02, 0.05).items():
        rows = rows.withColumn(name, value)
    assert [r["level"] for r in rows.collect()] == [pytest.approx(0.0125)] * 4


def test_few_labels_certify_in_sequence(spark):
    """A stratum among four with 217 to 305 good texts held out gets its rules."""
    r = random.Random(13)
    rows, labels = [], []
    for i in range(430):
        words = prose(i, 40).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                words[r.randrange(40)] = r.choice(["vile", "nasty", "rotten"])
        rows.append((i, " ".join(words), "es" if i >= 3 else "abc"[i], "", 0))
        labels.append((i, 1, int(bad)))
    docs = table(spark, rows)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    abusive, fitted = quality_rules.abusive_words(docs, labels)
    found = quality_rules.thresholds(quality_rules.measured(docs, abusive), labels, fitted).collect()
    assert [(x["stratum"], x["rule"], x["n_wrong"]) for x in found] == [("es", "abuse", 0)]
    assert 217 <= found[0]["n_good"] < 306
    kept = {x["doc_id"]: x["kept"] for x in quality_rules.judged(docs, labels).collect()}
    assert all(kept[i] == (i % 4 != 0) for i in range(4, 430))


def test_abusive_words_are_rated_by_all_texts(spark):
    """A word that most texts without a label hold is no abuse, whichever texts those are, and all
    labelled texts that are for fitting take part."""
    docs = spark.range(60_000).selectExpr(
        "id as doc_id",
        """concat_ws(' ', 'plain words', 'of', id,
            if(id < 24000 and id % 2 = 0, 'vile nasty', null),
            if(id >= 30000 and pmod(xxhash64(8, id), 3) > 0, 'vile', null)) as text""",
        "'en' as lang",
    )
    labels = spark.range(30_000).selectExpr("id as doc_id", "1 as quality", "int(id < 24000 and id % 2 = 0) as toxic")
    words, fitted = quality_rules.abusive_words(docs, labels)
    assert words == ["nasty"]
    turn = F.xxhash64(F.lit(7), "doc_id")
    fitting = labels.where(F.pmod(turn, F.lit(2)) == 0).where((F.col("toxic") == 1) | (F.pmod(turn, F.lit(8)) == 0))
    assert fitted.count() == fitting.count() > 8000
    found = quality_rules.judged(docs, labels).where("doc_id >= 30000")
    assert found.where("measures.abuse > 0").count() == 0


def test_blocks_of_shuffled_rows_are_checkpointed(spark, tmp_path):
    rows = table(spark, [(i, prose(i, 30), "", "", 0) for i in range(40)])
    rows.write.parquet(str(tmp_path / "docs"))
    scan = spark.read.parquet(str(tmp_path / "docs"))
    for docs, kept in ((scan, False), (scan.repartition(5), True), (scan.groupBy("doc_id").agg(F.first("text").alias("text")), True)):
        made = blocks.steady(blocks.blocks_of(docs, "doc_id", "text"))
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert ("MapInArrow" not in plan) == kept


def test_answers_for_other_documents_end_the_job(spark):
    rows = [(i, prose(i, 30), "", "", 0) for i in range(4)]
    asked = blocks.blocks_of(table(spark, rows).coalesce(1), "doc_id", "text")
    other = blocks.blocks_of(table(spark, rows[1:]).coalesce(1), "doc_id", "text")
    notes = blocks.answered(blocks.sent(asked, lambda columns: []), lambda bucket, values: values)

    def finish(columns, answers):
        return pa.table({"n": pa.array([len(columns[0])], pa.int64())})

    done = blocks.finished(blocks.shuffled(asked), notes, finish, "n bigint")
    assert done.collect()[0]["n"] == 4
    with pytest.raises(Exception, match="split anew"):
        blocks.finished(blocks.shuffled(other), notes, finish, "n bigint").collect()


def test_class_factor_near_and_far(spark):
    """Chances of classes are right whether scores lie close or out of the range of 32-bit floats,
    and pairs are numbered as ``np.unique`` does."""
    r = np.random.default_rng(4)
    prior = np.zeros(lm_scoring.CLASSES, np.float32)
    for size in (0.5, 400.0):
        weights = r.normal(0, size, (50, lm_scoring.CLASSES)).astype(np.float32)
        rows = [r.integers(0, 50, 300).astype(np.uint16) for _ in range(4)]
        exact = sum(weights[x].astype(float) for x in rows)
        exact -= exact.max(axis=1, keepdims=True)
        exact -= np.log(np.exp(exact).sum(axis=1, keepdims=True))
        kind = exact.argmax(axis=1)
        found = lm_scoring.class_probabilities(prior, weights, rows)
        assert np.allclose(found, np.exp(exact), atol=1e-3) and np.allclose(found.sum(axis=1), 1, atol=1e-5)
        logs = lm_scoring.class_logs(prior, weights, rows, kind)
        assert np.allclose(logs, exact[np.arange(300), kind], atol=1e-3)
    for top in (1, 5, 1 << 15, 1 << 16, 1 << 40):
        for n in (0, 1, 5000):
            values = r.integers(0, top, n)
            want, at = np.unique(values, return_inverse=True)
            found = lm_scoring.distinct(values)
            assert np.array_equal(found[0], want) and np.array_equal(found[1], at)
