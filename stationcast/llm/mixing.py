"""Mixing sources to target weights by entropy balancing.

* ``water_fill``: targets in proportion to the weights, none above ``cap`` times its
  source's size; the excess is shared again by weight until none is above.
* ``solve_dual``: of all rate vectors that meet the token constraints, the one closest (in
  relative entropy) to the base rates is the exponentially tilted r_d = base_d * exp(lambda_s),
  kept below ``cap``.  Base rates differ by document (``size_prior``), so rates differ within a source.  Newton steps on the convex dual; every step is one distributed
  aggregation over (source, base rate) cells, which hold the sufficient statistics.
* ``round_plan``: rates become whole copies.  Every document keeps floor(r); the fractions are
  spent in the order hash / fraction (sequential Poisson order) up to the tokens that are
  missing, so each source ends within one document of its target; the last gap is filled with
  one document of each of some distinct sizes, largest first.  The order is cut inside one hash
  bucket per source, so no source is ever gathered in one task.

The decision for a row depends on its own values and one row per source, so applying a plan to
whole documents moves no text.

Results for odd rows: a null source is a source of its own (last in order); null text has size 0;
documents of size 0 get one copy if their rate is 1 or more, else none; rows equal in doc_id, size and
source are taken together; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
BUCKET_ROWS = 20_000   # rows of a source that one hash bucket holds on average, about
TOLERANCE = 1e-9
MAX_STEPS = 60
FULL_BITS = 8          # documents of 128 words or more have the base rate 1


def source_key(c: Column) -> Column:
    """Never null: 's' + name, or 'n' for the null source."""
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c.cast("string")))


def source_sizes(rows: DataFrame) -> DataFrame:
    """(skey, source_size, weight): one row per source, weights repeating in code-point order."""
    by = rows.groupBy("skey").agg(F.sum("size").alias("source_size"))
    # one row per source name goes through this window
    order = Window.orderBy((F.col("skey") == "n").asc(), F.col("skey"))
    place = F.row_number().over(order) - 1
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    return by.withColumn("weight", F.get(cycle, F.pmod(place, F.lit(len(WEIGHTS)))))


def water_fill(sizes: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds target: min(cap * size, level * weight), the level meeting share * all sizes."""
    order = Window.orderBy(F.col("__ratio"), F.col("skey"))
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    t = (sizes.withColumn("__cap", F.col("source_size") * F.lit(cap))
         .withColumn("__ratio", F.col("__cap") / F.col("weight"))
         .withColumn("__budget", F.sum("source_size").over(everything) * F.lit(share))
         .withColumn("__w", F.sum("weight").over(everything))
         .withColumn("__cap_before", F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
         .withColumn("__w_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("__level", (F.col("__budget") - F.col("__cap_before")) / (F.col("__w") - F.col("__w_before")))
         .withColumn("__full", F.col("__ratio") <= F.col("__level")))
    level = F.min(F.when(~F.col("__full"), F.struct("__ratio", "skey", "__level"))).over(everything)["__level"]
    return (t.withColumn("target", F.when(F.col("__full"), F.col("__cap")).otherwise(F.col("weight") * level))
            .select("skey", "source_size", "weight", "target"))


def solve_dual(cells: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """targets with ``lam``: cells are (skey, base, tokens).  Newton steps on the logarithm of the dual's
    gradient equation (tokens taken = target), inside a bracket [low, high] of each source's root; a step
    that leaves the bracket (off the flat part where rates are at the cap) becomes its midpoint.  Each step
    is one aggregation over the cells."""
    start = [F.lit(0.0).alias("lam"), F.lit(-60.0).alias("low"), F.lit(60.0).alias("high")]
    state = cut(targets.select("*", *start), "dual")
    for _ in range(MAX_STEPS):
        tilted = F.col("base") * F.exp("lam")
        sums = (cells.join(state.select("skey", "lam"), "skey").groupBy("skey")
                .agg(F.sum(F.col("tokens") * F.least(F.lit(cap), tilted)).alias("__f"),
                     F.sum(F.when(tilted < cap, F.col("tokens") * tilted).otherwise(0.0)).alias("__d")))
        gap = F.col("target") - F.coalesce(F.col("__f"), F.lit(0.0))
        settled = F.abs(gap) <= F.lit(TOLERANCE) * F.greatest(F.col("target"), F.lit(1.0))
        newton = F.when((F.col("__d") > 0) & (F.col("target") > 0),
                        F.col("lam") + F.log(F.col("target") / F.col("__f")) * F.col("__f") / F.col("__d"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        state = cut(
            state.join(sums, "skey", "left").withColumn("open", ~settled & (F.col("target") > 0))
            .withColumn("low", F.when(F.col("open") & (gap > 0), F.col("lam")).otherwise(F.col("low")))
            .withColumn("high", F.when(F.col("open") & (gap < 0), F.col("lam")).otherwise(F.col("high")))
            .withColumn("lam", F.when(~F.col("open"), F.col("lam")).when(inside, newton)
                        .otherwise((F.col("low") + F.col("high")) / 2))
            .select("skey", "source_size", "weight", "target", "lam", "low", "high", "open"), "dual")
        if state.filter("open").isEmpty():
            break
        state = state.drop("open")
    return state.select("skey", "source_size", "weight", "target", "lam")


def _uniform(c: Column) -> Column:
    """52 hash bits of the id as a number in [0, 1)."""
    digest = F.md5(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def with_rates(rows: DataFrame, info: DataFrame, buckets: int, cap: float = CAP) -> DataFrame:
    """rows (doc_id, size, skey, base) joined with their source's row: whole copies and hash order."""
    rate = F.when((F.col("target") <= 0), F.lit(0.0)).otherwise(
        F.round(F.least(F.lit(cap), F.col("base") * F.exp("lam")), 9))
    j = rows.join(info, "skey", "left").withColumn("rate", rate).withColumn("whole", F.floor("rate"))
    part = F.col("rate") - F.col("whole")
    return (j.withColumn("okey", F.when(part > 0, _uniform(F.col("doc_id")) / part))
            .withColumn("bucket", F.least(F.floor(F.col("okey") * buckets), F.lit(16 * buckets)).cast("long")))


def round_plan(rows: DataFrame, solved: DataFrame, buckets: int, cap: float = CAP) -> tuple[DataFrame, DataFrame]:
    """(info, fill): one row per source with the cut of its order, and the few documents
    (skey, doc_id, size) that fill the last gaps."""
    d = with_rates(rows, solved, buckets, cap)
    wholes = d.groupBy("skey").agg(F.sum(F.col("whole") * F.col("size")).alias("__whole"))
    per_bucket = (d.filter("bucket is not null").groupBy("skey", "bucket").agg(F.sum("size").alias("__b"))
                  .withColumn("__cum", F.sum("__b").over(Window.partitionBy("skey").orderBy("bucket"))))
    need = (solved.join(wholes, "skey", "left")
            .withColumn("need", F.col("target") - F.coalesce(F.col("__whole"), F.lit(0))).drop("__whole"))
    crit = (per_bucket.join(need.select("skey", "need"), "skey").filter(F.col("__cum") > F.col("need"))
            .groupBy("skey").agg(F.min(F.struct("bucket", (F.col("__cum") - F.col("__b")).alias("under"))).alias("c"))
            .select("skey", F.col("c.bucket").alias("crit"), F.col("c.under").alias("under")))
    need = cut(need.join(crit, "skey", "left"), "mix-need")
    inside = with_rates(rows, need, buckets, cap).filter(F.col("bucket") == F.col("crit"))
    peers = Window.partitionBy("skey").orderBy("okey", "doc_id", "size")  # equal rows stand together
    last = (inside.withColumn("__cum", F.sum("size").over(peers) + F.col("under"))
            .filter(F.col("__cum") <= F.col("need")).groupBy("skey")
            .agg(F.max(F.struct("okey", "doc_id", "size")).alias("cut"), F.max("__cum").alias("taken")))
    info = cut(need.join(last, "skey", "left"), "mix-info")
    gap = F.col("need") - F.coalesce(F.col("taken"), F.col("under"))
    spare = (with_rates(rows, info, buckets, cap).filter((F.col("bucket") >= F.col("crit")) & ~extra_copy())
             .filter((F.col("size") > 0) & (F.col("size") <= gap)))
    # one unrepeated document for each distinct size; the list is as long as there are sizes below one gap
    single = (spare.groupBy("skey", "size", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.first(gap).alias("gap"))
              .filter("n = 1 and doc_id is not null").groupBy("skey", "size")
              .agg(F.min("doc_id").alias("doc_id"), F.first("gap").alias("gap")))
    listed = single.groupBy("skey").agg(
        F.sort_array(F.collect_list(F.struct("size", "doc_id")), False).alias("options"), F.first("gap").alias("gap"))
    picked = F.expr("""aggregate(options,
        named_struct('left', cast(gap as double), 'got', cast(array() as array<struct<size:bigint,doc_id:bigint>>)),
        (acc, x) -> if(x.size <= acc.left,
                       named_struct('left', acc.left - x.size, 'got', concat(acc.got, array(x))), acc),
        acc -> acc.got)""")
    fill = (listed.select("skey", F.explode(picked).alias("x"))
            .select("skey", F.col("x.doc_id").alias("__fill_id"), F.col("x.size").alias("__fill_size")))
    return info, cut(fill, "mix-fill")


def extra_copy() -> Column:
    """True where the hash order gives a document one copy more than floor(rate)."""
    at_cut = F.struct(F.col("okey"), F.col("doc_id"), F.col("size")) <= F.col("cut")
    return F.coalesce(F.col("bucket").isNotNull() & (F.col("crit").isNull() | (F.col("bucket") < F.col("crit"))
                                                    | ((F.col("bucket") == F.col("crit")) & F.coalesce(at_cut, F.lit(False)))),
                      F.lit(False))


class MixPlan:
    """A solved mix: ``copies(rows)`` adds the number of copies to rows (doc_id, size, skey, base)."""

    def __init__(self, rows: DataFrame, share: float = SHARE, cap: float = CAP):
        sizes = cut(source_sizes(rows), "mix-sources")
        self.targets = water_fill(sizes, share, cap)
        cells = cut(rows.groupBy("skey", "base").agg(F.sum("size").alias("tokens")), "mix-cells")
        n = rows.count()
        self.cap, self.buckets = cap, max(64, n // BUCKET_ROWS)
        solved = solve_dual(cells, self.targets, cap)
        self.info, self.fill = round_plan(rows, solved, self.buckets, cap)

    def copies(self, rows: DataFrame) -> DataFrame:
        d = with_rates(rows, self.info, self.buckets, self.cap)
        d = d.join(self.fill.withColumnRenamed("skey", "__fill_key"),
                   (F.col("__fill_key") == F.col("skey")) & (F.col("__fill_id") == F.col("doc_id"))
                   & (F.col("__fill_size") == F.col("size")), "left")
        more = extra_copy() | F.col("__fill_id").isNotNull()
        return d.withColumn("copies", (F.col("whole") + more.cast("int")).cast("int"))


def size_prior(size: Column) -> Column:
    """Base rate of a document by its size class (binary digits of the size): 1 from ``FULL_BITS`` digits on, down to
    about one half for the shortest, so short fragments are repeated less.  The classes keep the cells few."""
    return F.lit(0.5) + F.least(F.length(F.bin(size)), F.lit(FULL_BITS)) / F.lit(2.0 * FULL_BITS)


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), word_count(F.col(text_col)).alias("size"),
                       source_key(F.col(source_col)).alias("skey")).withColumn("base", size_prior(F.col("size")))


def mix_decisions(docs: DataFrame, share: float = SHARE, cap: float = CAP, **cols) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, rate for every document."""
    rows = cut(sized(docs, **cols), "mix-rows")
    return MixPlan(rows, share, cap).copies(rows).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        "copies", "rate")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The mixed documents: each row as often as its copies, with its own columns only."""
    plan = MixPlan(cut(sized(docs, id_col, text_col, source_col), "mix-rows"), share, cap)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                        F.col(id_col).cast("long").alias("doc_id"), word_count(F.col(text_col)).alias("size"),
                        source_key(F.col(source_col)).alias("skey")).withColumn("base", size_prior(F.col("size")))
    return (plan.copies(whole).filter("copies > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*"))
