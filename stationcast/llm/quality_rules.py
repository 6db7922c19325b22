"""Quality rules: base counts plus a hashed n-gram log-likelihood ratio.

Two multinomials over ``BUCKETS`` hashed 1- and 2-grams are counted: one over the texts of trusted
documents, one over the raw corpus (all documents).  A document's ratio is the mean, over its n-grams,
of log p_trusted - log p_raw (add-one smoothed); a trusted document is rated with counts that leave it
out, so it compares with documents without a label.  All of it is Spark SQL: counting combines map-side and
ends in ``BUCKETS`` rows, and rating looks the ratios up in a literal array of that size.

Texts meet the labels once, to be counted: ids and texts are shuffled for it, as labels grow with the documents, never
the n-grams, which are longer.  The second and last pass over the texts needs no label: it leaves both ratios of a
document, with and without its own n-grams among the trusted counts, in a row of numbers, and these rows are
joined with the labels by their size.  Mark bits, a bounded table, spare documents that cannot be trusted the second one.

The ratio also holds the language's share among the trusted and the smoothing of small counts, so no constant
fits all tables.  Each run takes the level of a language from its trusted documents (their median ratio; of
all its documents of ``MIN_WORDS`` words if it has none), pools the labelled documents' distances from their
levels and sets one cut where good and junk distances are told apart with the least error.  The score is the
distance from the level less that cut; a document is kept when no base rule fails and its score reaches
``THRESHOLD``, 0.

Every labelled document takes part: all documents labelled good define the target, and they and all those labelled
junk set the cut.  Spark joins the labels by their size; the raw counts and the scores cover every document.

Results for odd rows: a null text has no words, fails the base rules and scores 0; without labels of both kinds
all scores are 0 and only the base rules decide; rows of equal doc_id are judged each; an empty table
gives no rows; labels of unknown documents and null labels are ignored; a null language, or a table without the
column, is a language of its own; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CLASS, cut

BUCKETS = 10_000
MIN_WORDS = 50
THRESHOLD = 0.0               # scores are distances from the run's own cut
STEP = 0.001                  # bin width of the ratios that set levels and cut
SYMBOLS = "[#*$%&|<>]"
MARK_SLOTS = 1 << 17          # rows of 64 mark bits that are broadcast, at most


def with_words(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.regexp_extract_all(text, F.lit(WORD_CLASS), F.lit(0)).alias("words"), *more)


def gram_buckets(buckets: int) -> Column:
    """Bucket numbers of all 1- and 2-grams of ``words``."""
    return F.expr(f"""concat(
        transform(words, w -> cast(pmod(xxhash64(w), {buckets}) as int)),
        transform(words, (w, i) -> if(i > 0, cast(pmod(xxhash64(get(words, i - 1), w), {buckets}) as int),
                                             cast(pmod(xxhash64('', w), {buckets}) as int))))""")


def labelled_ids(labels: DataFrame) -> DataFrame:
    """(__mark, __good): every labelled id once; one with labels of both kinds is trusted."""
    marked = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    return marked.groupBy(F.col("doc_id").alias("__mark")).agg((F.max("quality") == 1).alias("__good"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labelled_ids(labels).filter("__good").select(F.col("__mark").alias("__trusted"))


def gram_counts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                buckets: int = BUCKETS) -> tuple[list[int], list[int]]:
    """Each bucket's n-grams in all and in the trusted documents; ``trusted`` has each id once."""
    marked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        trusted.hint("shuffle_hash"), F.col("doc_id") == F.col("__trusted"), "left")
    rows = with_words(marked, "doc_id", "text", F.col("__trusted").isNotNull().cast("long").alias("t"))
    # explode_outer: for explode, Spark would infer a filter that builds the n-grams a second time
    counts = (rows.select("t", F.explode_outer(gram_buckets(buckets)).alias("bucket"))
              .filter("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("good"))).collect()
    raw, good = [0] * buckets, [0] * buckets
    for r in counts:
        raw[r["bucket"]], good[r["bucket"]] = r["raw"], r["good"]
    return raw, good


def mark_of(id_col: str) -> tuple[Column, Column]:
    """(slot, bit) of an id."""
    h = F.xxhash64(F.col(id_col).cast("string"))
    return F.pmod(h, F.lit(MARK_SLOTS)), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")


def mark_bits(trusted: DataFrame) -> DataFrame:
    """(__slot, __bits): a bit is set for each trusted id, at a place that other ids share."""
    slot, bit = mark_of("__trusted")
    return (trusted.select(slot.alias("__slot"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b"))
            .groupBy("__slot").agg(F.bit_or("b").alias("__bits")))


def may_be_trusted(docs: DataFrame, trusted: DataFrame, id_col: str) -> DataFrame:
    """docs with __may: true for every trusted document, and for few others as long as the bits are many to one id."""
    slot, bit = mark_of(id_col)
    found = docs.join(F.broadcast(mark_bits(trusted)), slot == F.col("__slot"), "left")
    return found.withColumn("__may", F.coalesce(F.call_function("getbit", F.col("__bits"), bit) == 1, F.lit(False)))


def ratios_of(raw: list[int], good: list[int]) -> list[float]:
    buckets, n_raw, n_good = len(raw), sum(raw), sum(good)
    if not n_good:
        return [0.0] * buckets
    return [round(math.log((g + 1) / (n_good + buckets)) - math.log((r + 1) / (n_raw + buckets)), 6)
            for g, r in zip(good, raw)]


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               buckets: int = BUCKETS) -> list[float]:
    """log p_trusted / p_raw of each bucket; ``trusted`` has each id once."""
    return ratios_of(*gram_counts(docs, trusted, id_col, text_col, buckets))


def _array(values: list, kind: str) -> str:
    return f"cast(split('{','.join(map(str, values))}', ',') as array<{kind}>)"


def ratio_sums(raw: list[int], good: list[int]) -> tuple[Column, Column]:
    """Sum of the log ratios of ``grams``, and what is added to it where they leave the trusted counts (of no meaning for
    a document that is not in them).
    In bucket order, each run of equal buckets adds k log(1 - k / (good + 1)) at its end, k being its length."""
    table, smoothed = _array(ratios_of(raw, good), "double"), _array([n + 1 for n in good], "double")
    total = sum(good) + len(good)
    without = f"""if(size(grams) = 0, 0D, transform(array(sort_array(grams)), s ->
        aggregate(
            filter(sequence(0, size(s) - 1), i -> not(get(s, i) <=> get(s, i + 1))),
            struct(-1 as last, 0D as total),
            (a, i) -> struct(i as last, a.total + (i - a.last) * ln(1D - (i - a.last) / get({smoothed}, get(s, i))) as total),
            a -> a.total))[0] + size(grams) * ln({total}D / nullif({total}D - size(grams), 0D)))"""
    return F.expr(f"aggregate(grams, 0D, (a, b) -> a + get({table}, b))"), F.expr(without)


def mean_ratio(own: Column) -> Column:
    """Mean log ratio of a rated document; where ``own`` holds, its n-grams leave the trusted counts."""
    return F.when(F.col("n_words") == 0, 0.0).otherwise(
        (F.col("ratios") + F.when(own, F.col("without")).otherwise(0.0)) / (2 * F.col("n_words")).cast("int"))


def _median(bins: list[tuple[float, int]]) -> float:
    half, seen = sum(n for _, n in bins) / 2, 0
    for s, n in sorted(bins):
        seen += n
        if seen >= half:
            return s
    return 0.0


def best_cut(good: dict[float, int], junk: dict[float, int]) -> float:
    """Where the share of good below plus the share of junk from there on is least (the middle of the gap; the
    widest gap of equal ones).  Below all, if no place tells them apart."""
    n_good, n_junk = sum(good.values()), sum(junk.values())
    places = sorted({*good, *junk})
    best, lost, left = (1.0, 0.0, places[0] - STEP), 0, n_junk
    for s, after in zip(places, places[1:]):
        lost, left = lost + good.get(s, 0), left - junk.get(s, 0)
        best = min(best, (lost / n_good + left / n_junk, s - after, (s + after) / 2))
    return best[2]


def _histogram(rated: DataFrame, good: Column) -> list:
    """Counts of (lang, good, ratio rounded to STEP) over the rated documents long enough; good ones are left out of the counts."""
    rows = rated.filter(F.col("n_words") >= MIN_WORDS).select(
        "lang", good.alias("good"), F.round(mean_ratio(good) / STEP).cast("long").alias("bin"))
    return [(r["lang"], r["good"], r["bin"] * STEP, r["n"])
            for r in rows.groupBy("lang", "good", "bin").agg(F.count(F.lit(1)).alias("n")).collect()]


def language_cuts(rated: DataFrame, labels: DataFrame) -> dict[str, float] | None:
    """The ratio of each language from which documents are kept; None without labels of both kinds."""
    bins = _histogram(rated.join(labelled_ids(labels), F.col("doc_id") == F.col("__mark")), F.col("__good"))
    if len({g for _, g, _, _ in bins}) < 2:
        return None
    level = {x: _median([(s, n) for y, g, s, n in bins if g and y == x]) for x in {y for y, g, _, _ in bins if g}}
    others = _histogram(rated.filter(~F.col("lang").isin(list(level))), F.lit(False))
    level |= {x: _median([(s, n) for y, _, s, n in others if y == x]) for x in {y for y, _, _, _ in others}}
    away: dict[bool, dict[float, int]] = {True: {}, False: {}}
    for x, g, s, n in bins:
        at = round(s - level[x], 6)
        away[g][at] = away[g].get(at, 0) + n
    cut_at = best_cut(away[True], away[False])
    return {x: round(v + cut_at, 6) for x, v in level.items()}


def repeated_words() -> Column:
    """Words inside 3-word windows found twice or more, from ``windows`` (a hash per window).
    Texts without a repeated window stop at the distinct count; for the others the windows are sorted
    by (hash, place), those with an equal neighbour give their places, and each place in order
    adds the words that the place before it has not covered."""
    return F.expr("""if(size(array_distinct(windows)) = size(windows), 0L,
        transform(array(sort_array(transform(windows, (h, i) -> struct(h, i)))), s ->
            aggregate(
                sort_array(transform(
                    filter(s, (x, i) -> coalesce(get(s, i - 1).h = x.h, false) or coalesce(get(s, i + 1).h = x.h, false)),
                    x -> x.i)),
                struct(0L as total, -3 as last),
                (a, p) -> struct(a.total + least(3, p - a.last) as total, p as last),
                a -> a.total))[0])""")


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     buckets: int = BUCKETS, threshold: float = THRESHOLD,
                     lang_col: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    trusted = trusted_ids(labels)
    raw, good = gram_counts(docs, trusted, id_col, text_col, buckets)
    base = with_words(may_be_trusted(docs, trusted, id_col), id_col, text_col, lang.alias("lang"), F.col("__may")).select(
        "doc_id", "lang", "__may", F.size("words").cast("long").alias("n_words"),
        F.expr("aggregate(words, 0L, (a, w) -> a + char_length(w))").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.expr("filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("lines"),
        F.expr("""if(size(words) < 3, cast(array() as array<bigint>),
                     transform(sequence(0, size(words) - 3),
                               i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))))""").alias("windows"),
        gram_buckets(buckets).alias("grams"))
    ratios, without = ratio_sums(raw, good)
    rated = cut(base.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words().alias("n_repeat_words"), ratios.alias("ratios"),
        F.when(F.col("__may"), without).alias("without")), "quality-ratios")
    cuts = language_cuts(rated, labels)
    if cuts is None:
        score = F.lit(0.0)
    else:
        # languages without a document of MIN_WORDS words have no level, and no document that passes the base rules
        least = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for x in cuts.items() for v in x]), F.col("lang")), F.lit(0.0))
        score = F.when(F.col("n_words") == 0, 0.0).otherwise(mean_ratio(F.col("__trusted").isNotNull()) - least)
    judged = rated.join(trusted, F.col("doc_id") == F.col("__trusted"), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", score.alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    return (judged.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))))
