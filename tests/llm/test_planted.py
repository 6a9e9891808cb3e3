"""A planted corpus: the pipeline stage by stage, and the queries without SQL, against plain Python."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import pytest
import regex
import tokenizers
import xxhash

import corpus_pipeline
from sessionloom.llm import quality_rules as rules
from sessionloom.llm import secrets
from sessionloom.llm.queries import QUERIES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ABUSE = ["vile", "nasty", "rotten", "ärgernis"]
FOOTER = "All rights reserved by the owner"


def prose(r, n, vocabulary=4000):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def made():
    """Hosts with footers, labels enough to certify in one language, copies and near copies, benchmark
    passages, repeated lines, secrets, nulls, blanks and very short texts."""
    r = random.Random(20)
    docs, labels, benchmark = [], [], [(i, prose(r, 30, 10**6)) for i in range(12)]
    benchmark += [(12, "three short words"), (13, None), (14, "")]
    hosts = [f"h{i}" for i in range(12)]
    for i in range(460):
        words = prose(r, 60).split()
        toxic = i % 9 == 0
        for _ in range(5 if toxic else 0):
            words[r.randrange(60)] = r.choice(ABUSE).title() if r.random() < 0.3 else r.choice(ABUSE)
        text = " ".join(words[:30]) + "\n" + " ".join(words[30:])
        host = r.choice(hosts[:4])
        if host in ("h0", "h1"):
            text += f"\n  {FOOTER} "
        docs.append((i, text, "en" if i % 10 else "de", host))
        labels.append((i, int(i % 23 != 5), int(toxic)))
    labels += [(99_999, 1, 0), (None, 1, 1), (3, None, None), (7, 1, 1)]
    n = 1000
    for i in range(8):
        docs.append((n + i, docs[20 + i][1], "en", "h5"))
        near = docs[40 + i][1].split()
        near[3] = "changed"
        docs.append((n + 20 + i, " ".join(near), "en", "h6"))
        docs.append((n + 40 + i, prose(r, 40) + " " + benchmark[i][1][:200] + " " + prose(r, 40), "en", "h7"))
        docs.append((n + 60 + i, "\n".join(["same line of words here"] * 9 + [prose(r, 25)]), "en", "h8"))
    # A host of five pages with a footer, one text many times.
    docs += [(n + 100 + i, f"{prose(r, 40)}\n{FOOTER} at h9", None, "h9") for i in range(5)]
    docs += [(n + 120 + i, "copied text " + docs[30][1], "en", "h10") for i in range(25)]
    body = "abcdefghij0123456789ABCDEFGHIJ"
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = secrets.BASE62[digit] + digits
    planted = {
        n + 200: (f"é password = 'hunter2secret' {prose(r, 20)}", []),
        n + 201: (f"AKIA{'Q7' * 9} and {'0af3' * 9} end {prose(r, 20)}", []),
        n + 202: (f"𝄞 use ghp_{body}{digits} now {prose(r, 20)}", [("github", 6, 46)]),
        n + 203: (f"ghp_{body}000000 is none {prose(r, 20)}", []),
        n + 204: (f"IBAN DE89 3704 0044 0532 0130 00 {prose(r, 20)}", [("iban", 5, 32)]),
        n + 205: (f"card 4111 1111 1111 1111 12/26, token: abcdef {prose(r, 20)}", [("card", 5, 24)]),
    }
    docs += [(i, text, "en", "h11") for i, (text, _) in planted.items()]
    docs += [(n + 300, None, "en", "h0"), (n + 301, "", "fr", None), (n + 302, " \n\t", "fr", "h0"), (n + 303, "Tiny", "fr", "h0")]
    docs += [(n + 310, "#*$%&|<> " * 12 + prose(r, 12), "en", "h3"), (n + 311, prose(r, 30).upper(), "en", "h3")]
    return docs, labels, benchmark, {i: extra for i, (_, extra) in planted.items()}


DOCS, LABELS, BENCHMARK, SECRETS = made()


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("planted")
    documents = [(*row, None if row[1] is None else len(row[1]), "x") for row in DOCS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, toxic string"
    for name, rows, columns in (
        ("documents", documents, schema),
        ("labels", LABELS, "doc_id long, quality int, toxic int"),
        ("benchmark", BENCHMARK, "item_id long, text string"),
    ):
        frame = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), columns)
        frame.repartition(3).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


# -- quality rules ---------------------------------------------------------------------------


def measures(text, abusive):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = collections.Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    chars = sum(map(len, words))
    symbols = sum(c in "#*$%&|<>" for c in text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dup = len(lines) - len(set(lines))
    n = len(words)
    listed = regex.compile(r"(?<!\p{L})(?:" + "|".join(abusive) + r")(?!\p{L})") if abusive else None
    values = {
        "symbols_per_100": symbols * 100.0 / max(chars, 1),
        "shouted_percent": len(re.findall("[A-ZÀ-ÖØ-Þ]", text)) * 100.0 / max(chars, 1),
        "dup_lines_percent": 100.0 * dup / max(len(lines), 1),
        "repeated_percent": 100.0 * len(hit) / max(n, 1),
        "word_chars": chars / max(n, 1),
        "abuse": float(len(listed.findall(text.lower()))) if listed else 0.0,
    }
    failed = n < 20 or 100 * len(hit) > 30 * n
    return (n, chars, symbols, dup, len(hit), failed), values


def turn(doc_id):
    seed = xxhash.xxh64(struct.pack("<i", 7), seed=42).intdigest()
    return xxhash.xxh64(struct.pack("<q", doc_id), seed=seed).intdigest()


def certified():
    """(abusive words, {stratum: {rule: cutoff}})."""
    kinds = {}
    for doc, quality, toxic in LABELS:
        if doc is not None:
            q, t = kinds.get(doc, (1, 0))
            kinds[doc] = min(q, quality or 0), max(t, toxic or 0)
    texts = {d: t for d, t, *_ in DOCS}
    fit = {d: t for d, (q, t) in kinds.items() if (t and turn(d) % 2 == 0) or (not t and q and turn(d) % 8 == 0)}
    langs = {d: lang for d, _, lang, _ in DOCS}
    sets = {(langs[d], t, (texts[d] or "").lower()) for d, t in fit.items() if d in texts}
    n_toxic = collections.Counter(lang for lang, t, _ in sets if t)
    in_toxic, in_all, of_lang = collections.Counter(), collections.Counter(), collections.Counter()
    for lang, t, text in sets:
        for word in set(regex.findall(r"\p{L}+", text)):
            in_all[word] += 1
            in_toxic[word] += t
            of_lang[lang, word] += t
    plain = [(lang, set(regex.findall(r"\p{L}+", (t or "").lower()))) for d, t, lang, _ in DOCS if d not in kinds]
    n_plain = collections.Counter(lang for lang, _ in plain)
    in_plain = collections.Counter((lang, w) for lang, words in plain for w in words)
    abusive = sorted({
        w
        for (lang, w), n in of_lang.items()
        if n >= max(4.0, 0.05 * n_toxic[lang])
        and in_toxic[w] >= 0.95 * in_all[w]
        and n / n_toxic[lang] >= 6 * in_plain[lang, w] / (n_plain[lang] + 50)
    })
    seen = collections.defaultdict(list)
    for doc, text, lang, _ in DOCS:
        base, values = measures(text, abusive)
        if not base[5]:
            q, t = kinds.get(doc, (None, 0))
            seen[lang].append((None if q is None else q == 1 and t == 0, doc in fit, values))
    n_good = {s: sum(g is True and not f for g, f, _ in rows) for s, rows in seen.items()}
    least = sorted((0.98**n if n else 1.0, s) for s, n in n_good.items())
    level, spent = {}, 0.0
    reached = [s for k, (_, s) in enumerate(least) if sum(x for x, _ in least[: k + 1]) <= 0.05]
    spent = sum(x for x, s in least if s in reached)
    for x, s in least:
        level[s] = x + (0.05 - spent) / len(reached) if s in reached else 0.0
    cutoffs = {}
    for stratum, rows in seen.items():
        cells = []
        fit_good = sum(g is True and f for g, f, _ in rows)
        n_plain = sum(g is None for g, _, _ in rows)
        for rule, grid in rules.RULES.items():
            before, lift = 0, math.inf
            for step, cutoff in enumerate(grid):
                over = [(g, f) for g, f, v in rows if v[rule] > cutoff]
                wrong = sum(g is True and not f for g, f in over)
                caught = sum(g is False and not f for g, f in over)
                fit_wrong = sum(g is True and f for g, f in over)
                every = sum(g is False for g, _ in over)
                hoped = every - rules.WRONG_COST * fit_wrong * (n_good[stratum] + fit_good) / max(fit_good, 1)
                if every > before and hoped > 0:
                    lift = min(lift, every * (n_plain + 1) / (sum(g is None for g, _ in over) + 1))
                    cells.append((fit_wrong, -lift, rule, step, (rule, cutoff, wrong, caught)))
                before = every
        best = {}
        for *_, (rule, cutoff, wrong, caught) in sorted(cells, key=lambda c: c[:4]):
            n = n_good[stratum]
            tail = sum(math.comb(n, k) * 0.02**k * 0.98 ** (n - k) for k in range(wrong + 1)) if wrong < 0.02 * n else 1.0
            if tail > level[stratum]:
                break
            gain = caught - rules.WRONG_COST * wrong
            if gain > 0:
                best[rule] = max(best.get(rule, (0, 0)), (gain, cutoff))
        cutoffs[stratum] = {rule: cutoff for rule, (_, cutoff) in best.items()}
    return abusive, cutoffs


@pytest.fixture(scope="module")
def verdicts():
    abusive, cutoffs = certified()
    out = {}
    for doc, text, lang, _ in DOCS:
        base, values = measures(text, abusive)
        broken = [rule for rule in rules.RULES if values[rule] > cutoffs.get(lang, {}).get(rule, math.inf)]
        out[doc] = (*base, not base[5] and not broken, ",".join(broken))
    return out


def test_planted_labels_certify():
    abusive, cutoffs = certified()
    assert set(ABUSE) <= set(abusive) and "abuse" in cutoffs["en"]
    assert not cutoffs.get("de")


def test_op10(spark, sf_dir, verdicts):
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op10_quality_rules"](spark, sf_dir).collect()}
    assert found == verdicts
    # Most toxic texts of the certified language go, clean ones stay.
    toxic = [i for i in range(0, 460, 9) if i % 10]
    assert sum(not found[i][6] for i in toxic) > 0.8 * len(toxic)
    assert all(found[i][6] for i in range(460) if i % 9 and i != 7)


# -- secrets ---------------------------------------------------------------------------------


def base_spans(text):
    text = text or ""
    out = []
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    for kind, pattern, size in (("assign", assign, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 20), ("hex", re.compile("[0-9a-f]+"), 24)):
        for m in pattern.finditer(text):
            if len(m[2] if kind == "assign" else m[0]) >= size:
                out.append((kind, m.start(), m.end()))
    return out


def test_op7(spark, sf_dir):
    order = {kind: i for i, kind in enumerate(secrets.KINDS)}

    def joined(spans):
        return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]])))

    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op7_secrets"](spark, sf_dir).collect()}
    want = {}
    for doc, text, *_ in DOCS:
        base = base_spans(text)
        counts = [sum(k == kind for k, *_ in base) for kind in ("assign", "access", "hex")]
        digest = hashlib.sha256(joined(base).encode()).hexdigest()
        want[doc] = (*counts, digest, joined(base + SECRETS.get(doc, [])))
    assert found == want
    assert sum(sum(row[:3]) for row in want.values()) >= 4


# -- pipeline --------------------------------------------------------------------------------


def without_boilerplate(rows):
    hosts = collections.defaultdict(set)
    for _, text, _, host in rows:
        hosts[host].add(text)
    drop = {}
    for host, texts in hosts.items():
        times = collections.Counter(x for t in texts for x in {line.strip(" \t\n\x0b\x0c\r") for line in (t or "").split("\n")} if x)
        drop[host] = {x for x, n in times.items() if n >= 3 and n > 0.1 * len(texts)}
    out = []
    for doc, text, lang, host in rows:
        kept = None if text is None else "\n".join(x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r") not in drop[host])
        out.append((doc, kept, lang, host))
    return out


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def one_of_each(rows):
    sets = {}
    for doc, text, *_ in rows:
        words = WORD.findall(lowered(text))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    top = {doc: doc for doc in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b]) if sets[a] else 0
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return [row for row in rows if root(row[0]) == row[0]]


def clean(rows):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for _, text in BENCHMARK:
        words = word.findall(lowered(text))
        windows |= {tuple(words[i : i + 10]) for i in range(max(len(words) - 9, 1))} if words else set()
    sizes = {len(w) for w in windows}

    def hit(text):
        words = word.findall(lowered(text))
        return any(tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1))

    return [row for row in rows if not hit(row[1])]


def test_pipeline_stage_by_stage(spark, sf_dir, verdicts, tmp_path):
    wanted = [
        lambda rows: [row for row in rows if verdicts[row[0]][6]],
        without_boilerplate,
        one_of_each,
        clean,
    ]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = DOCS
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:-1], wanted, strict=True):
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        before, rows = rows, plain(rows)
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "toxic"]
        found = sorted((r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect())
        assert found == sorted(rows), name
        # The stage has something to do here.
        assert found != sorted(before), name
    # Near copies of texts that lost no footer are gone, and so is every planted passage.
    assert sum(1020 <= d < 1028 for d, *_ in rows) < 8 and not any(1040 <= d < 1048 for d, *_ in rows)
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    check_pieces(pieces, {d: t or "" for d, t, *_ in rows})


def check_pieces(pieces, texts):
    encode = tokenizers.Tokenizer.from_file(tokenizer_path()).encode
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(texts)
    for doc, mine in by_doc.items():
        ids = [*encode(texts[doc], add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(mine, key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{p['length']}I", *ids[p["start"] : at]))
        assert at == len(ids)
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
