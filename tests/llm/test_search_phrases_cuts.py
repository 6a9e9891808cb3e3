"""Top-k search, collocations and fill-in-middle against brute force, awkward rows included."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sessionloom.llm import automata, collocations, fill_middle, topk_search
from sessionloom.llm.automata import CountAutomaton
from sessionloom.llm.common import ship

# -- top-k search ----------------------------------------------------------------------------


def floored(vector):
    if vector is None or any(x is None or not np.isfinite(x) for x in vector):
        return None
    return [int(np.floor(1024 * float(x))) for x in vector]


def brute_top(rows, query_ids, k):
    sound = [(i, v) for i, v in ((i, floored(v)) for i, v in rows) if v is not None]
    out = set()
    for query, q in {(i, tuple(v)) for i, v in sound if i in query_ids}:
        scores = [
            (-sum(a * b for a, b in zip(q, v, strict=True)), i is None, i or 0, i)
            for i, v in sound
            if i != query and len(v) == len(q)
        ]
        out |= {(query, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def found_top(spark, rows, query_ids, schema="vec_id long, embedding array<float>, dim int, v string", **options):
    frame = spark.createDataFrame([(*row, 7, "x") for row in rows], schema)
    queries = frame.where(F.col("vec_id").isin(list(query_ids)))
    found = topk_search.top_k(frame, queries, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return [tuple(r) for r in found.collect()]


def test_top_k_awkward_vectors(spark):
    ship(spark)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0]) for _ in range(4)]) for i in range(90)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(90, 130)]
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4)]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (300, [1.0, 2.0]), (301, [2.0, 1.0]), (302, []), (303, [])]
    rows += [(100, [0.5, 0.5, 0.5, 0.5]), (100, [0.25, 0.5, 0.5, 0.5])]
    asked = {0, 17, 95, 100, 200, 202, 300, 302}
    found = found_top(spark, rows, asked, k=7, least=64, group=3)
    assert len(found) == len(set(found))
    assert set(found) >= {(300, 1, 301, 4 * 1024**2), (302, 1, 303, 0)}
    for k in (1, 7):
        assert set(found_top(spark, rows, asked, k=k, least=64)) == brute_top(rows, asked, k)
    assert found_top(spark, [], asked) == []


def test_scores_beyond_a_double_are_exact(spark):
    ship(spark)
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-(2.0**18), 2.0**18) for _ in range(5)]) for i in range(60)]
    schema = "vec_id long, embedding array<double>, dim int, v string"
    found = found_top(spark, rows, {1, 2, 3}, schema, k=10, least=20)
    assert set(found) == brute_top(rows, {1, 2, 3}, 10)
    assert any(abs(row[3]) > 1 << 53 for row in found)


def test_tree_prunes_and_shared_score_holds(monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.integers(-300, 300, (40, 16))
    points = centres[rng.integers(0, 40, 8000)] + rng.integers(-9, 10, (8000, 16))
    ids = rng.permutation(8000)
    tree = topk_search.BallTree(points, ids, leaf=50)
    opened = []
    open_leaves = topk_search.BallTree._open
    monkeypatch.setattr(
        topk_search.BallTree,
        "_open",
        lambda self, q, b, query, part: (opened.append(len(part)), open_leaves(self, q, b, query, part)),
    )
    query, found, score = tree.search(points[:30], ids[:30], np.full(30, topk_search.NONE), 10)
    exact = points[:30] @ points.T
    for i in range(30):
        order = sorted((-exact[i, j], ids[j]) for j in range(8000) if ids[j] != ids[i])[:10]
        assert [(-s, n) for n, s in zip(found[query == i], score[query == i], strict=True)] == order
    # Far fewer leaves than all for each query.
    assert sum(opened) < 30 * (len(tree.bounds[-1]) - 1) / 3
    floor = np.array([score[query == i][-1] + 1 for i in range(30)])
    again = tree.search(points[:30], ids[:30], floor, 10)
    assert all(len(again[0][again[0] == i]) < 10 for i in range(30))
    assert (again[2] >= floor[again[0]]).all()


# -- automata and collocations -----------------------------------------------------------------

PHRASES = st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1, max_size=40)


def table_of(phrases):
    rows = np.array([p + [0] * (4 - len(p)) for p in phrases], np.int64)
    return automata.summed(rows, np.ones(len(rows), np.int64))[:2]


@settings(max_examples=150, deadline=None)
@given(PHRASES, PHRASES)
def test_automata(one, two):
    a, b = (CountAutomaton.of(*table_of(p)) for p in (one, two))
    rows, counts = table_of(one)
    back, weights = a.phrases()
    assert back.tolist() == rows.tolist() and weights.tolist() == counts.tolist()
    known = dict(zip(map(tuple, table_of(two)[0].tolist()), table_of(two)[1].tolist(), strict=True))
    assert a.matched(b)[2].tolist() == [known.get(tuple(r), 0) for r in rows.tolist()]
    united, sums, numbers = automata.union([a, b])
    assert united.tolist() == table_of(one + two)[0].tolist()
    assert sums.tolist() == table_of(one + two)[1].tolist()
    assert united[numbers[0]].tolist() == rows.tolist()
    # No two states are equal.
    states = [
        tuple(zip(*(c[a.first[s] : a.first[s + 1]].tolist() for c in (a.label, a.weight, a.target)), strict=True))
        for s in range(len(a.first) - 1)
    ]
    assert len(states) == len(set(states))


def brute_collocations(rows, least, top, covered=80):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    frequent = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    out = {}
    for (lang, words), a in frequent.items():
        within = [
            n
            for (other, longer), n in frequent.items()
            if other == lang
            and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        ]
        if any(100 * n >= covered * a for n in within):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        phrase = " ".join(words)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, left, right))
    return {
        (lang, rank, phrase, -a, left, right, sizes[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    }


@pytest.mark.parametrize("least, top", [(2, 2000), (3, 40)])
def test_collocations(spark, least, top):
    ship(spark)
    rng = random.Random(6)
    words = ["New", "york", "city", "of", "Été", "a\x00b", "x-y", "日本", "the", "The", "zz"]
    rows = [
        (
            rng.choice(["en", "fr", None, "und", ""]),
            "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randrange(40))),
        )
        for _ in range(120)
    ]
    rows += [("en", None), (None, None), ("de", ""), ("en", " .,;"), *[("en", "new york city hall")] * 30]
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "lang string, text string, words string, a int, n int")
    # Small blocks and many buckets.
    found = collocations.top_phrases(frame.repartition(5), top=top, min_count=least, bucket_bytes=300)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in found.collect()} == brute_collocations(rows, least, top)
    assert collocations.top_phrases(frame.limit(0)).collect() == []


def test_long_text_is_cut_between_pieces():
    text = b"one two three. " * 50
    parts = list(collocations._cut(collocations.plain(text), 100))
    assert b"\n".join(parts) == collocations.plain(text)
    assert max(map(len, parts)) <= 100
    assert list(collocations._cut(b"x" * 500, 100)) == [b"x" * 500]
    assert b"".join(collocations._windows(b"ab " * 900_000)) == b"ab " * 900_000


# -- fill-in-middle ----------------------------------------------------------------------------


def brute_cut(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.sampled_from(["a", "é", "𝄞", " ", "\n", "\t", "\x0b", "word", "<P", ">", "　"]), max_size=60),
    st.integers(0, 1000),
    st.sampled_from([1, 2, 3, 7, 1000]),
)
def test_cut_at_every_frame_size(parts, doc_id, frame_bytes):
    text = "".join(parts)
    frames = fill_middle.frames_of(text.encode(), frame_bytes)
    n, marked = sum(f["units"] for f in frames), any(m in text for m in ("<P>", "<S>", "<M>"))
    form, prefix, middle, out = fill_middle.transformed(str(doc_id), n, marked, frames)
    output = b"".join(fill_middle.stream(out)).decode()
    assert (n, form, prefix, middle, output) == brute_cut(doc_id, text)
    assert b"".join(fill_middle.restored(out, form)).decode() == text


def test_only_cut_frames_are_opened(monkeypatch):
    text = b" ".join(b"w%d" % i for i in range(20_000))
    frames = fill_middle.frames_of(text, 1000)
    count = []
    opened = fill_middle.opened
    monkeypatch.setattr(fill_middle, "opened", lambda f: (count.append(1), opened(f))[1])
    left, right = fill_middle.split(frames, 7777)
    assert len(count) <= 1
    assert b"".join(fill_middle.stream(left)) == b" ".join(b"w%d" % i for i in range(7777))
    assert sum(f["units"] for f in right) == 20_000 - 7777
    count.clear()
    assert b"".join(fill_middle.stream(frames, 5500, 6200)) == text[5500:6200] and len(count) == 2


def test_fill_middle(spark):
    ship(spark)
    rows = [(i, f"Words of text {i}, é\n\nmore  of it " * (i % 7)) for i in range(60)]
    rows += [(None, "some words"), (70, None), (71, ""), (72, " \n "), (73, "holds <M> itself"), (3, rows[3][1])]
    rows += [(80 + i, "x" * 300_000 + " tail") for i in range(3)] + [(90, "long words here " * 60_000)]
    frame = spark.createDataFrame([(*r, 5, "f") for r in rows], "doc_id long, text string, n int, frames string")
    stored = fill_middle.framed(frame)
    found = fill_middle.cut(stored).collect()
    assert len(found) == len(rows)
    want = sorted(((str(i) if i is not None else None), *brute_cut(i, t)[:4], brute_cut(i, t)[4], t or "") for i, t in rows if i is not None)
    got = sorted(
        (
            r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"],
            b"".join(fill_middle.stream([f.asDict() for f in r["frames"]])).decode(),
            b"".join(fill_middle.restored([f.asDict() for f in r["frames"]], r["form"])).decode(),
        )
        for r in found if r["doc_id"] is not None
    )
    assert got == want
    for r in found:
        body = b"".join(fill_middle.stream([f.asDict() for f in r["frames"]]))
        assert r["output_sha256"] == hashlib.sha256(body).hexdigest()
    texts = {(None if i is None else str(i)): t or "" for i, t in rows}
    assert all(r["restored_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in found)
    assert fill_middle.cut(fill_middle.framed(frame.limit(0))).collect() == []
