"""Secret scans: candidate strings, then a random forest that removes false positives.

Candidates are the runs of 12 or more token characters with a digit, every one of a word.  In a word of several
(minified JSON, CSV, URLs) each is rated with the piece of the word that ends in it.  Each one gets features from
its length, its character classes and their transitions, its coverage by frequent corpus words, path marks
and the neighbouring words.  A random forest (Spark ML, JVM only) trained on labelled findings gives the
probability that the candidate is a secret.  ``findings`` may be any labelled set; without one,
``format_labels`` labels this corpus' own candidates by issuer formats and assignments.

The dictionary is a Misra-Gries summary of all words (bounded counters, no shuffle of the vocabulary).
The forest sees distinct feature rows, weighted by their counts.  ``train_rows`` bounds them, in equal parts of each
label and in hash order; weights then make up for the rows left out of a label.

Results for odd rows: null and empty texts give no candidate; a value that occurs twice is reported at each
place; with one class only in the labels every candidate gets that class; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CLASS, cut, frequent, lower_ascii

DICTIONARY = 2000
TRACKED = 65536
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 6, 7
RUN = "[A-Za-z0-9+/_\\-]{12,}"
#: A whole run with a digit, and with it all of the word since the last such run.
PIECE = f"(?s)(.*?)((?<![A-Za-z0-9+/_\\-])(?=[A-Za-z+/_\\-]*[0-9]){RUN}={{0,2}})"
KEYWORDS = "(?i)(key|token|secret|passw|pwd|auth|credential|api)"
FEATURES = ["length", "digits", "uppers", "hex", "distinct", "transitions", "spoken", "dictionary", "path", "assigned", "keyword"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, position (word number), run (number in the word), word (or its piece), value, the neighbouring words."""
    words = docs.select(F.col(id_col).alias("doc_id"),
                        F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD_CLASS), F.lit(0)).alias("words"))
    # the neighbours are taken in the array, so that no row copies the whole text
    found = F.expr(f"""transform(
        filter(if(size(words) = 0, cast(array() as array<int>), sequence(0, size(words) - 1)),
               i -> octet_length(get(words, i)) >= 12 and get(words, i) rlike '[0-9]' and get(words, i) rlike '{RUN}'),
        i -> struct(i as position, get(words, i) as word, coalesce(get(words, i - 2), '') as before2,
                    coalesce(get(words, i - 1), '') as before1, coalesce(get(words, i + 1), '') as after1))""")
    # explode_outer: for explode, Spark would infer a filter that evaluates all this a second time
    rows = words.select("doc_id", F.explode_outer(found).alias("c")).filter("c is not null").select("doc_id", "c.*")
    rows = rows.withColumn("pieces", F.regexp_extract_all("word", F.lit(PIECE), F.lit(0)))
    runs = F.arrays_zip("pieces", F.regexp_extract_all("word", F.lit(PIECE), F.lit(2)).alias("values"))
    rows = rows.withColumn("runs", runs).select("*", F.posexplode_outer("runs").alias("run", "r")).filter("r is not null")
    one = F.size("pieces") == 1
    return rows.select("doc_id", "position", "run", F.when(one, F.col("word")).otherwise(F.col("r.pieces")).alias("word"),
                       "before2", "before1", "after1", F.col("r.values").alias("value"))


def dictionary(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY, tracked: int = TRACKED) -> list[str]:
    """The most frequent words of three letters or more over all documents (bounded list)."""
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    every = docs.select(F.explode_outer(F.regexp_extract_all(text, F.lit("[a-z]{3,}"), F.lit(0))).alias("w"))
    every = every.filter("w is not null")
    return sorted(r["item"] for r in frequent(every, "w", words, tracked).collect())     # at most ``words`` rows


def _share(c: Column) -> Column:
    return c / F.length("value")


def features(found: DataFrame, common: list[str]) -> DataFrame:
    value = F.col("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]", "0"), "[A-Z]", "A"), "[a-z]", "a")
    listed = "split('" + ",".join(common) + "', ',')"
    covered = F.expr(f"""aggregate(regexp_extract_all(lower(value), '[a-z]{{3,}}', 0), 0,
                                   (a, w) -> a + if(array_contains({listed}, w), char_length(w), 0))""")
    near = F.concat_ws(" ", "before2", "before1", F.regexp_extract("word", "^([A-Za-z_.\\-]+)[=:]", 1))
    return (found
            .withColumn("length", F.length("value").cast("double"))
            .withColumn("digits", _share(F.regexp_count("value", F.lit("[0-9]"))))
            .withColumn("uppers", _share(F.regexp_count("value", F.lit("[A-Z]"))))
            .withColumn("hex", value.rlike("^[0-9a-f]+$").cast("double"))
            .withColumn("distinct", _share(F.size(F.array_distinct(F.split(value, "")))))
            .withColumn("transitions", _share(F.regexp_count(kinds, F.lit("0+|A+|a+|[^0Aa]+"))))
            .withColumn("spoken", _share(F.regexp_count(F.lower(value), F.lit("[aeiou][^aeiou0-9]|[^aeiou0-9][aeiou]"))))
            .withColumn("dictionary", _share(covered))
            .withColumn("path", (F.col("word").rlike("://|@|^[./~]|[a-z]/[a-z]")).cast("double"))
            .withColumn("assigned", (F.col("word").rlike("[=:]") | F.col("before1").rlike("[=:]$")).cast("double"))
            .withColumn("keyword", near.rlike(KEYWORDS).cast("double")))


def format_labels(found: DataFrame) -> Column:
    """1 for issuer formats and for long mixed values assigned to a telling name, else 0."""
    issuer = F.col("value").rlike("^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$")
    near = F.concat_ws(" ", "before2", "before1", "word")
    named = near.rlike(KEYWORDS + "[A-Za-z_]*[\"']?\\s*[=:]") & (F.length("value") >= 16)
    return (issuer | named).cast("double")


def training_sample(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[DataFrame, list[float]]:
    """Distinct rows of FEATURES and label with a weight, at most train_rows; and the labels that occur."""
    shapes = cut(rows.groupBy(*FEATURES, "label").agg(F.count(F.lit(1)).cast("double").alias("weight")), "shapes")
    of_label = {r["label"]: r for r in shapes.groupBy("label").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("shapes")).collect()}
    kinds = sorted(k for k in of_label if k is not None)
    # labels with fewer shapes than their part leave the rest to the others
    room, part = train_rows, {}
    for left, k in enumerate(sorted(kinds, key=lambda k: (of_label[k]["shapes"], k))):
        part[k] = min(of_label[k]["shapes"], room // (len(kinds) - left))
        room -= part[k]
    sample = shapes.limit(0)
    for k in kinds:
        own = shapes.filter(F.col("label") == k)
        if part[k] < of_label[k]["shapes"]:
            own = cut(own.orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(part[k]), "findings")
            seen = own.agg(F.sum("weight")).first()[0] or 1.0
            own = own.withColumn("weight", F.col("weight") * F.lit(of_label[k]["n"] / seen))
        sample = sample.unionByName(own)
    return cut(sample, "findings"), kinds


def train_forest(rows: DataFrame, train_rows: int = TRAIN_ROWS):
    """A fitted pipeline over FEATURES, or the only label's value when there is one class."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    sample, kinds = training_sample(rows, train_rows)
    if len(kinds) < 2:
        return kinds[0] if kinds else 0.0
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH,
                                    seed=SEED)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(sample)


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                 train_rows: int = TRAIN_ROWS, keep_at: float = 0.5) -> DataFrame:
    """doc_id, position, run, value, context, probability, is_secret for every candidate.
    ``findings``: labelled rows (word, value, before2, before1, after1, label), if there are any."""
    from pyspark.ml.functions import vector_to_array
    common = dictionary(docs, text_col)
    rows = cut(features(candidates(docs, id_col, text_col), common), "candidates")
    labelled = (rows.withColumn("label", format_labels(rows)) if findings is None
                else features(findings, common).withColumn("label", F.col("label").cast("double")))
    model = train_forest(labelled, train_rows)
    if isinstance(model, float):
        rated = rows.withColumn("p", F.lit(model))
    else:
        rated = model.transform(rows).withColumn("p", F.get(vector_to_array("probability"), F.lit(1)))
    return rated.select("doc_id", F.col("position").cast("long").alias("position"), F.col("run").cast("long").alias("run"), "value",
                        F.concat_ws(" ", "before2", "before1", "word", "after1").alias("context"),
                        F.round("p", 9).alias("probability"), (F.round("p", 9) >= keep_at).alias("is_secret"))
