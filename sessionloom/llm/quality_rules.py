"""Quality rules with risk-controlled thresholds, in SQL expressions only.

Every text gets a few measures (below). A rule rejects texts whose measure exceeds a cutoff.
Cutoffs are selected per stratum from labelled texts held out from fitting: of a fixed grid, a
cutoff is certified if the exact binomial test rejects "it rejects at least ``risk`` of the
good texts" at the stratum's level; the levels of all strata add up to ``delta`` and go by the
number of good texts held out (``_levels``). The cutoffs of all rules of a stratum are tested in one
fixed sequence up to the first that fails, which costs no further correction, so with
probability 1 - ``delta`` all certified cutoffs keep their promise at once. The sequence is
made without the good texts of the test: a cutoff is in it if it catches more bad labelled texts
than the milder one and gains by the good texts used in fitting; those that reject fewest of
these come first, and among equals those that catch most bad texts for each text without a label
that would go. Of a rule's certified cutoffs the one is taken that gains most on the
labels held out, a good text lost weighing ``WRONG_COST`` bad ones caught, the mildest of equals;
a rule that gains nothing is left out. A stratum with too few labels certifies nothing (149
good ones are needed at least) and its texts meet the base rules alone.

Base rules, applied always: fewer than 20 words, or more than 30 % of the words in 8-word
windows that occur twice.

Abusive words are learned from all labelled texts: words of the toxic ones that good ones do not hold
and that are rare in texts without a label, all of which are counted. The test is about good texts, so
all toxic ones teach the list that is tested, and of the good ones one in ``FIT_GOOD``, which takes no
part in the test. What the other good texts hold is struck off the list after the test: with fewer words
no text counts more of them, so every certified cutoff keeps its promise. Of the toxic texts one in
``FIT_TOXIC`` makes a first list; how many texts a cutoff catches is told, for the toxic others, by that
list, which has not seen them. The list is short by construction: each word is in 5 % of the toxic texts
of some stratum at least.

Defined results: a null text has no words and fails the base rules; a null stratum is a
stratum; contradicting labels of one id count as bad; labels of unknown ids are ignored;
repeated rows are judged each; without labels the base rules stand alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm.common import SPACE_RUN, stored

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
RISK = 0.02
DELTA = 0.05
# Of the toxic labelled texts one in so many makes the first list; of the good ones one in so many is
# out of the test.
FIT_TOXIC, FIT_GOOD = 2, 8
MIN_SHARE = 0.05
# How much rarer a word must be in texts without a label. UNSEEN texts without it are assumed beside
# them, so that a handful decides nothing.
LIFT, UNSEEN = 6.0, 50
WRONG_COST = 10
# Cutoffs of each rule, mildest first: reject if the measure is larger.
RULES = {
    "symbols_per_100": [20.0, 15.0, 10.0, 8.0, 6.0, 4.0, 3.0, 2.0, 1.0],
    "shouted_percent": [90.0, 80.0, 70.0, 60.0, 50.0, 40.0],
    "dup_lines_percent": [60.0, 50.0, 40.0, 30.0],
    "repeated_percent": [25.0, 20.0, 15.0, 10.0],
    "word_chars": [30.0, 25.0, 20.0, 15.0],
    "abuse": [9.0, 6.0, 4.0, 3.0, 2.0, 1.0, 0.0],
}


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN, -1), lambda w: w != "")


def _letter_runs(text: Column) -> Column:
    """Words that may be abusive, lowered; the first and the last may be empty."""
    return F.split(F.lower(text), r"[^\p{L}]+", -1)


def _listed(text: Column, words: list[str]) -> Column:
    """The listed words of a text, as often as they occur."""
    if not words:
        return F.array().cast("array<string>")
    return F.filter(_letter_runs(text), lambda w: w.isin(words))


def abusive_words(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    min_share: float = MIN_SHARE,
) -> tuple[list[str], DataFrame]:
    """(words of the list that is tested, ids of the labelled texts out of the test). A word is
    abusive if ``min_share`` of the toxic texts of some stratum have it, four at least, hardly any
    good text of any stratum does, and it is rare in texts without a label."""
    candidates, fitted = _candidates(docs, labels, doc_id, text, stratum, min_share)
    listed = _words_of(candidates)
    body = F.col(text).cast("string")
    held = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(stratum).cast("string").alias("stratum"),
        _text_id(body).alias("text_id"),
        _listed(body, listed).alias("found"),
    )
    if not listed:
        return [], fitted
    return _lists(stored(held, "held_words"), labels, candidates)[0], fitted


def _text_id(text: Column) -> Column:
    """Equal for texts that are copies but for capitals."""
    return F.xxhash64(F.lower(text))


def _words_of(rows: DataFrame) -> list[str]:
    return sorted(r["word"] for r in rows.select("word").distinct().collect())


def _kinds(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, quality) of every labelled id."""
    return (
        labels.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(
            F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"),
            F.min(F.coalesce("quality", F.lit(0))).alias("quality"),
        )
    )


def _hardly_good(in_toxic: Column, in_good: Column, fit_toxic: int, fit_good: int) -> Column:
    """Of one toxic text in FIT_TOXIC and one good in FIT_GOOD that have a word, 95 % are toxic; the
    counts are of one text in ``fit_toxic`` and one in ``fit_good``."""
    toxic, good = in_toxic * (fit_toxic / FIT_TOXIC), in_good * (fit_good / FIT_GOOD)
    return toxic >= 0.95 * (toxic + good)


def _candidates(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str,
    text: str,
    stratum: str,
    min_share: float = MIN_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """((word, in_toxic, stratum, share of its toxic texts, first) by the labelled texts that are not good
    ones of the test, ids that are out of the test). ``first``: of the first list, else of the one by all
    toxic texts; ``in_toxic``: toxic texts of all strata with the word."""
    kinds = _kinds(labels).withColumn("turn", F.xxhash64(F.lit(7), "doc_id"))
    # What the test needs are good texts, so few of those are spent.
    good = f"toxic = 0 and quality = 1 and pmod(turn, {FIT_GOOD}) = 0"
    late = F.expr(f"toxic = 1 and pmod(turn, {FIT_TOXIC}) != 0")
    picked = kinds.where(f"toxic = 1 or ({good})").select("doc_id", "toxic", late.alias("late"))
    picked = stored(picked, "fit_rows")
    chosen = picked.select(F.col("doc_id").alias("fit_id"), "toxic", "late")
    given = docs.select(
        F.col(doc_id).alias("given_id"),
        F.col(stratum).cast("string").alias("stratum"),
        F.lower(F.col(text).cast("string")).alias("text"),
    )
    texts = given.join(chosen, F.col("given_id") == F.col("fit_id"))
    # Copies count once.
    texts = texts.groupBy("stratum", "toxic", "text").agg(F.min("late").alias("late"))
    sets = texts.select(
        "stratum",
        "toxic",
        "late",
        F.array_distinct(F.expr("regexp_extract_all(text, '[\\\\p{L}]+', 0)")).alias("words"),
    )
    sets = stored(sets, "fit_words")
    early = F.expr("toxic = 1 and not late")
    totals = sets.groupBy(F.col("stratum").alias("of_stratum")).agg(
        F.sum("toxic").alias("n_toxic"), F.count_if(early).alias("n_early")
    )
    per_stratum = (
        sets.select("stratum", "toxic", "late", F.explode("words").alias("word"))
        .groupBy("stratum", "word")
        .agg(
            F.sum("toxic").alias("in_toxic"),
            F.count_if(early).alias("in_early"),
            F.count_if(F.col("toxic") == 0).alias("in_good"),
        )
        .join(totals, F.col("stratum").eqNullSafe(F.col("of_stratum")))
    )

    def often(n: str, of: str, first: bool) -> Column:
        share = F.col(n) / F.greatest(of, F.lit(1))
        enough = F.col(n) >= F.greatest(F.lit(4.0), min_share * F.col(of))
        return F.array_agg(F.when(enough, F.struct("stratum", share.alias("share"), F.lit(first).alias("first"))))

    # Empty if good texts hold the word.
    early_rows = F.when(_hardly_good(F.col("in_early"), F.col("in_good"), FIT_TOXIC, FIT_GOOD), F.col("early_rows"))
    all_rows = F.when(_hardly_good(F.col("in_toxic"), F.col("in_good"), 1, FIT_GOOD), F.col("all_rows"))
    nothing = F.array().cast("array<struct<stratum:string,share:double,first:boolean>>")
    found = (
        per_stratum.groupBy("word")
        .agg(
            F.sum("in_toxic").alias("in_toxic"),
            F.sum("in_early").alias("in_early"),
            F.sum("in_good").alias("in_good"),
            often("in_early", "n_early", True).alias("early_rows"),
            often("in_toxic", "n_toxic", False).alias("all_rows"),
        )
        .select(
            "word",
            "in_toxic",
            F.explode(F.concat(F.coalesce(early_rows, nothing), F.coalesce(all_rows, nothing))).alias("often"),
        )
        .select("word", "in_toxic", "often.*")
    )
    return stored(found, "candidates"), picked.where("not late").select("doc_id")


def _lists(
    held: DataFrame, labels: DataFrame, candidates: DataFrame
) -> tuple[list[str], list[str], list[str]]:
    """(the list that is tested, the first list, what good texts leave of the one tested).

    Listed are candidates that the texts without a label have LIFT times less often than toxic ones of a
    stratum they are often in: few good texts do not show how common a word is there. (Where more
    than one text in LIFT is toxic, no word is that much rarer.) ``held``: doc_id, stratum, text_id and
    ``found``, the candidates in it, of every text."""
    kinds = _kinds(labels)
    rows = held.select("doc_id", F.col("stratum").alias("in_stratum"), "text_id", F.array_distinct("found").alias("found"))
    plain = rows.join(kinds, "doc_id", "left_anti")
    # A row with no word for the text itself.
    words = F.concat(F.array(F.lit(None).cast("string")), "found")
    times = plain.select("in_stratum", F.explode(F.coalesce(words, F.array(F.lit(None)))).alias("plain_word"))
    # At most one row per stratum and candidate.
    times = stored(times.groupBy("in_stratum", "plain_word").agg(F.count("*").alias("n")), "plain_words")
    n_plain = times.where("plain_word is null").select("in_stratum", F.col("n").alias("n_plain"))
    in_plain = times.where("plain_word is not null").withColumnRenamed("n", "in_plain")
    of = F.col("stratum").eqNullSafe(F.col("in_stratum"))
    rated = candidates.join(n_plain, of, "left").drop("in_stratum")
    rated = rated.join(in_plain, of & (F.col("word") == F.col("plain_word")), "left")
    usual = F.coalesce(F.col("in_plain") / (F.col("n_plain") + UNSEEN), F.lit(0.0))
    rated = rated.where(F.col("share") >= LIFT * usual)
    # Copies count once, as in the candidates.
    good = rows.where("size(found) > 0").join(kinds.where("toxic = 0 and quality = 1"), "doc_id", "left_semi")
    good = good.select("in_stratum", "text_id", F.explode("found").alias("word")).distinct()
    in_good = good.groupBy("word").agg(F.count("*").alias("in_good"))
    of_good = F.coalesce("in_good", F.lit(0))
    lists = (
        rated.join(in_good, "word", "left")
        .groupBy("word")
        .agg(
            F.bool_or("first").alias("first"),
            F.bool_or(~F.col("first")).alias("tested"),
            F.bool_and(_hardly_good(F.col("in_toxic"), of_good, 1, 1)).alias("left"),
        )
        .collect()
    )
    return (
        sorted(r["word"] for r in lists if r["tested"]),
        sorted(r["word"] for r in lists if r["first"]),
        sorted(r["word"] for r in lists if r["tested"] and r["left"]),
    )


def measured(
    docs: DataFrame,
    abusive: list[str],
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    keep_rows: bool = False,
) -> DataFrame:
    """(row struct of the input row, doc_id, stratum, text_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, found, measures) of every row, ``row`` null unless asked for, ``found`` its
    abusive words; nothing is shuffled.

    Each level is a projection of its own, so that arrays are built once per text.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    whole = F.struct("*")
    level = docs.select(
        (whole if keep_rows else F.lit(None).cast("string")).alias("row"),
        F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), body.alias("text")
    )
    words = level.select(
        "row",
        "doc_id",
        "stratum",
        "text",
        _words(F.col("text")).alias("words"),
        F.filter(
            F.split("text", "\n", -1), lambda line: F.translate(line, " \t\x0b\x0c\r", "") != ""
        ).alias("lines"),
    )
    counts = words.select(
        "row",
        "doc_id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.regexp_replace("text", "[A-ZÀ-ÖØ-Þ]", ""))).alias("capitals"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _text_id(F.col("text")).alias("text_id"),
        _listed(F.col("text"), abusive).alias("found"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    gets = ", ".join(f"hashes[i + {k}]" for k in range(WINDOW))
    windows = counts.withColumn(
        "windows",
        F.expr(
            f"if(n_words < {WINDOW}, array(), "
            f"transform(sequence(0, cast(n_words as int) - {WINDOW}), i -> xxhash64({gets})))"
        ),
    ).drop("hashes")
    # Most texts repeat nothing; only the others are sorted.
    ranked = windows.withColumn(
        "sorted",
        F.expr(
            "if(size(windows) = size(array_distinct(windows)), null, "
            "array_sort(transform(windows, (h, i) -> struct(h, i))))"
        ),
    ).drop("windows")
    hit = ranked.withColumn(
        "hit",
        F.expr(
            "array_sort(transform(filter(sorted, (w, k) -> "
            "(k > 0 and sorted[greatest(k - 1, 0)].h = w.h) or "
            "(k < size(sorted) - 1 and sorted[least(k + 1, size(sorted) - 1)].h = w.h)), w -> w.i))"
        ),
    ).drop("sorted")
    # A window adds the words up to the next one, its whole length at most.
    repeated = hit.withColumn(
        "n_repeat_words",
        F.expr(
            "coalesce(aggregate(transform(hit, (p, k) -> "
            f"if(k + 1 < size(hit), least({WINDOW}, hit[least(k + 1, size(hit) - 1)] - p), {WINDOW})), "
            "0L, (s, x) -> s + x), 0L)"
        ),
    ).drop("hit")
    failed = F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words"
    )
    per_char = "100.0 / greatest(word_chars, 1)"
    measures = {
        "symbols_per_100": F.expr(f"n_symbols * {per_char}"),
        "shouted_percent": F.expr(f"capitals * {per_char}"),
        "dup_lines_percent": F.expr("100.0 * n_dup_lines / greatest(n_lines, 1)"),
        "repeated_percent": F.expr("100.0 * n_repeat_words / greatest(n_words, 1)"),
        "word_chars": F.expr("1.0 * word_chars / greatest(n_words, 1)"),
        "abuse": F.size("found"),
    }
    return repeated.select(
        "row",
        "doc_id",
        "stratum",
        "text_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "found",
        F.struct(*[v.cast("double").alias(k) for k, v in measures.items()]).alias("measures"),
    )


def binomial_tail(n: str, k: str, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), summed exactly in logarithms. ``n``, ``k``: SQL of longs
    with 0 <= k <= n."""
    first = f"({n}) * {math.log1p(-p)!r}D"
    odds = f"{math.log(p) - math.log1p(-p)!r}D"
    term = f"(a.term + ln(({n} - i + 1) / i) + {odds})"
    return F.expr(
        f"if({k} = 0, exp({first}), aggregate(sequence(1L, greatest({k}, 1L)), "
        f"named_struct('term', {first}, 'total', {first}), (a, i) -> named_struct("
        f"'term', {term}, 'total', greatest(a.total, {term}) + "
        f"log1p(exp(-abs(a.total - {term})))), a -> exp(a.total)))"
    )


def _levels(risk: float, delta: float) -> dict[str, Column]:
    """``level`` of each stratum: its part of ``delta``, by the number of its good texts alone and
    not by what the test finds. A stratum without a wrong rejection is certified at (1 - risk) **
    n_good; the strata that take least get that, as far as ``delta`` reaches, and equal parts of
    what is left. The others, whose labels could certify nothing beside them, get none."""
    everywhere = Window.partitionBy()
    ordered = Window.orderBy("_least", "stratum").rowsBetween(Window.unboundedPreceding, 0)
    least = F.when(F.col("n_good") > 0, F.pow(F.lit(1.0 - risk), F.col("n_good"))).otherwise(1.0)
    reached = F.sum("_least").over(ordered) <= delta
    paid = F.sum(F.when(F.col("_reached"), F.col("_least"))).over(everywhere)
    share = (F.lit(delta) - paid) / F.count_if("_reached").over(everywhere)
    return {
        "_least": least,
        "_reached": reached,
        "level": F.when(F.col("_reached"), F.col("_least") + share).otherwise(0.0),
    }


def thresholds(
    measures: DataFrame,
    labels: DataFrame,
    fitted: DataFrame,
    risk: float = RISK,
    delta: float = DELTA,
) -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_wrong, n_bad, n_caught) of every certified rule.

    ``measures``: result of ``measured``; ``fitted``: ids that took part in fitting, whose good
    texts shape the sequence of tests and are in none. With a column ``first_abuse``, that is the measure
    of the other toxic texts. The test sees texts that pass the base rules, as the others never come to the
    rules. One pass over the labelled measures; what remains is one row per stratum, rule and cutoff.
    """
    kinds = (
        _kinds(labels)
        .join(fitted.select("doc_id", F.lit(True).alias("fit")), "doc_id", "left")
        .select(
            F.col("doc_id").alias("label_id"),
            ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"),
            (F.col("toxic") == 1).alias("bad_words"),
            F.coalesce("fit", F.lit(False)).alias("fit"),
        )
    )
    first = "first_abuse" if "first_abuse" in measures.columns else "measures.abuse"
    passing = measures.where("not base_failed").select(
        "stratum", "doc_id", "measures", F.col(first).alias("first_abuse")
    )
    seen = passing.join(kinds, F.col("doc_id") == F.col("label_id"), "left")
    abuse = F.when(F.expr("bad_words and not fit"), F.col("first_abuse")).otherwise(F.col("measures.abuse"))
    seen = seen.withColumn("measures", F.col("measures").withField("abuse", abuse))
    # Null without a label: neither good nor bad.
    good, held, plain = F.col("good"), ~F.col("fit"), F.col("good").isNull()
    cells = [(rule, step, cutoff) for rule, grid in RULES.items() for step, cutoff in enumerate(grid)]

    def cell(rule: str, step: int, cutoff: float) -> Column:
        over = F.col(f"measures.{rule}") > cutoff
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(step).alias("step"),
            F.lit(cutoff).alias("cutoff"),
            F.count_if(held & good & over).alias("n_wrong"),
            F.count_if(held & ~good & over).alias("n_caught"),
            F.count_if(~held & good & over).alias("fit_wrong"),
            F.count_if(~good & over).alias("all_caught"),
            F.count_if(plain & over).alias("plain_over"),
        )

    counts = seen.groupBy("stratum").agg(
        F.count_if(held & good).alias("n_good"),
        F.count_if(held & ~good).alias("n_bad"),
        F.count_if(~held & good).alias("fit_good"),
        F.count_if(plain).alias("plain"),
        F.array(*[cell(*c) for c in cells]).alias("cells"),
    )
    # One row per stratum.
    counts = stored(counts, "cutoffs")
    for name, value in _levels(risk, delta).items():
        counts = counts.withColumn(name, value)
    rows = counts.where("n_good + n_bad + fit_good > 0").select(
        "stratum", "n_good", "n_bad", "fit_good", "plain", "level", F.inline("cells")
    )
    # What the test will see of good texts has no part in the sequence, only their number.
    of_rule = Window.partitionBy("stratum", "rule")
    milder = of_rule.orderBy("step")
    hoped = F.expr(f"all_caught - {WRONG_COST} * fit_wrong * (n_good + fit_good) / greatest(fit_good, 1)")
    useful = rows.withColumn(
        "useful", (F.col("all_caught") > F.lag("all_caught", 1, 0).over(milder)) & (hoped > 0)
    ).where("useful")
    # Bad texts caught for each share of the texts without a label that would go; a cutoff is never
    # ahead of a milder one of its rule.
    lift = F.expr("all_caught * (plain + 1) / (plain_over + 1)")
    upto = milder.rowsBetween(Window.unboundedPreceding, 0)
    useful = useful.withColumn("lift", F.min(lift).over(upto))
    sequence = Window.partitionBy("stratum").orderBy("fit_wrong", F.desc("lift"), "rule", "step")
    # Above the risk itself the test cannot reject; the sum is then not needed.
    sure = F.when(
        F.col("n_wrong") < risk * F.col("n_good"), binomial_tail("n_good", "n_wrong", risk)
    ).otherwise(1.0)
    passed = F.min(sure <= F.col("level")).over(sequence.rowsBetween(Window.unboundedPreceding, 0))
    gain = F.expr(f"n_caught - {WRONG_COST} * n_wrong").alias("gain")
    certified = useful.withColumn("passed", passed).where("passed").select("*", gain).where("gain > 0")
    best = certified.groupBy("stratum", "rule").agg(
        F.max_by(
            F.struct("cutoff", "n_good", "n_wrong", "n_bad", "n_caught"),
            F.struct("gain", "cutoff"),
        ).alias("best")
    )
    return best.select("stratum", "rule", "best.*")


def judged(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    risk: float = RISK,
    delta: float = DELTA,
    keep_rows: bool = False,
) -> DataFrame:
    """Measures of every row with ``broken`` (rules it breaks) and ``kept``."""
    candidates, fitted = _candidates(docs, labels, doc_id, text, stratum)
    listed = _words_of(candidates)
    measures = stored(measured(docs, listed, doc_id, text, stratum, keep_rows), "measures")
    # Texts are read once: which candidates are abusive shows in the ones found.
    tested, first, left = _lists(measures, labels, candidates) if listed else ([], [], [])

    def by(words: list[str]) -> Column:
        return F.size(F.filter("found", lambda w: w.isin(words))).cast("double")

    def counted(words: list[str]) -> DataFrame:
        return measures.withColumn("measures", F.col("measures").withField("abuse", by(words)))

    chosen = thresholds(counted(tested).withColumn("first_abuse", by(first)), labels, fitted, risk, delta)
    # A part of the words tested: no text counts more of them than in the test.
    measures = counted(left).drop("found", "text_id")
    # At most one row per stratum, with a cutoff per rule.
    per_stratum = chosen.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")
    )
    broken = F.filter(
        F.array(
            *[
                F.when(F.col(f"measures.{rule}") > F.col("cutoffs")[rule], rule)
                for rule in RULES
            ]
        ),
        lambda rule: rule.isNotNull(),
    )
    right = per_stratum.withColumnRenamed("stratum", "of_stratum")
    return (
        measures.join(right, F.col("stratum").eqNullSafe(F.col("of_stratum")), "left")
        .withColumn("broken", broken)
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
        .drop("of_stratum", "cutoffs")
    )
