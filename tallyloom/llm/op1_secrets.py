"""Secret scan whose false positives are removed by a random forest.

Candidates are private key blocks, passwords in URLs, whole values of six signs or more, quoted or not, that are assigned to a secret-like
name, and runs of key-like characters. Each gets features of its length, its character transitions (changes between letters, digits and cases, and
how likely its letter pairs are in the words of the corpus), how much of it words of the corpus cover, its path, and
the words beside it. A random forest trained on labelled findings scores them; those below ``threshold`` are
removed as false positives. Spark's own forest is used, so text never leaves the JVM and the trees are grown by distributed
aggregation. Words and letter pairs are learned from all documents (:func:`learn`).

Labels are a table of reviewed findings (``labels`` of :func:`scan`), or, where there are none as in :func:`query`, come from
:func:`label_by_context`: a value assigned to a secret-like name, with a provider's fixed prefix or of a format made for secrets is one, a number with a valid check
digit or a value without any such sign is none. The forest sees none of what that rule reads, so its verdict is a second opinion
and differs where the rule is wrong. :func:`held_out` measures it on findings kept apart. At most ``MAX_LABELLED`` findings train it, chosen by a hash of their document
and place; everything else covers all rows. Findings of a document are bounded by its text; no group of documents is ever gathered.

Defined results: a null or empty text has no candidates; a null path has no path features; repeated rows are scanned as often
as they occur (told apart by a number of the row in the given table); without labels of both classes there is no forest, the
score is null and the verdict follows the label (null: undecided, a finding that is not redacted); further columns are ignored, or passed on by
:func:`redact`, whatever they are called; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.names import unused
from tallyloom.operators.staging import stage

MAX_LABELLED = 20_000
CONTEXT = 60
TREES, DEPTH, SEED = 20, 6, 42
REMOVED_BELOW = 0.5
#: A word of the corpus has 3 to 20 letters and occurs in this many documents.
LEAST_DOCUMENTS = 5
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
#: Fixed patterns: a key-like run of 16 signs with a digit, or of 24 without; names of secrets; provider prefixes; path parts.
SIGNS = "A-Za-z0-9+/_-"
CANDIDATE = f"(?<![{SIGNS}])(?:(?=[A-Za-z+/_-]*+[0-9])[{SIGNS}]{{16,}}+|[{SIGNS}]{{24,}}+)"
NAMES = "token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential"
#: The value assigned to a name, to the closing quote or the next space, without closing punctuation; before a run in the alternation, so it is whole.
ASSIGNED = (f"(?<=[=:\\s\"'])(?<=[=:]\\s{{0,4}}[\"']?)(?<=(?i:{NAMES})[\"']?\\s{{0,4}}[=:]\\s{{0,4}}[\"']?)"
            "(?:(?<=\")[^\"\\r\\n]{6,}+(?=\")|(?<=')[^'\\r\\n]{6,}+(?=')"
            "|(?:(?<![\"'])|(?![^\"'\\n]*+[\"']))[^\\s\"'=:]\\S{4,}[^\\s,;.)\\]}>\"'])")
KEY_BLOCK = "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[^-]++-----END [A-Z ]{0,30}PRIVATE KEY-----"
IN_URL = "(?<=:)(?<=://[^\\s:/@\"']{1,64}:)[^\\s@/\"']{3,}+(?=@)"
FOUND = f"(?:{KEY_BLOCK}|{IN_URL}|{ASSIGNED}|{CANDIDATE})"
PLACEHOLDERS = "example|dummy|fake|your|placeholder|xxx"
PREFIXES = "^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}|^xox[abprs]-|^sk_live_|^glpat-|^-----BEGIN "
PATHS = {"path_test": "test|spec|fixture|mock", "path_docs": "example|sample|doc|readme|tutorial", "path_lock": "lock|vendor|node_modules|dist"}
FEATURES = ("length", "changes", "letter_pairs", "distinct_share", "digit_share", "upper_share", "hex", "dictionary",
            "path_test", "path_docs", "path_lock", "path_depth", "words_before", "words_after", "quoted", "after_word")


@dataclass(frozen=True)
class Learned:
    """What the corpus says of words: a staged table ``(word, documents)``, and the logarithm of each sign's probability after another."""

    words: DataFrame
    pairs: list[float]


def _words(text: Column) -> Column:
    """Lower-case words of 3 to 20 letters."""
    return F.filter(F.split(F.lower(text), "\\P{L}+"), lambda w: F.char_length(w).between(3, 20))


def learn(docs: DataFrame, text_col: str = "text", least_documents: int = LEAST_DOCUMENTS) -> Learned:
    """Words of the corpus by document frequency, and letter pairs weighted by it. The pairs are at most 37 * 37 numbers."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = stage(docs.select(F.explode(F.array_distinct(_words(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("documents"))
                  .where(F.col("documents") >= least_documents), "words")
    n = len(ALPHABET) + 1
    at = F.explode(F.sequence(F.lit(1), F.char_length("word") - 1)).alias("i")
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring("word", i, F.lit(1)))
    seen = (words.select("word", "documents", at).select(place(F.col("i")).alias("a"), place(F.col("i") + 1).alias("b"), "documents")
            .groupBy("a", "b").agg(F.sum("documents").alias("n")).collect())
    counts = [[1] * n for _ in range(n)]
    for r in seen:
        counts[r.a][r.b] += r.n
    return Learned(words, [math.log(x / sum(row)) for row in counts for x in row])


def candidates(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``keep``, ``ordinal`` (its number in the text), ``start`` (characters before it), ``value``, ``before`` and ``after`` of every candidate."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("_text")).where(F.col("_text").rlike(FOUND))
    rows = rows.select(*keep, F.split("_text", FOUND, -1).alias("_gaps"), F.regexp_extract_all("_text", F.lit(FOUND), F.lit(0)).alias("_values"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    lengths = F.transform("_values", lambda v, i: F.struct(F.char_length(F.col("_gaps")[i]).alias("gap"), F.char_length(v).alias("own")))
    starts = F.aggregate(lengths, zero, lambda a, x: F.struct((a.at + x.gap + x.own).alias("at"), F.array_append(a.starts, a.at + x.gap).alias("starts")),
                         lambda a: a.starts)
    found = F.transform(F.col("_values"), lambda v, i: F.struct(
        i.alias("ordinal"), F.col("_starts")[i].alias("start"), v.alias("value"), F.right(F.col("_gaps")[i], F.lit(CONTEXT)).alias("before"),
        F.left(F.col("_gaps")[i + 1], F.lit(CONTEXT)).alias("after")))
    return rows.withColumn("_starts", starts).select(*keep, F.explode(found).alias("_f")).select(*keep, "_f.*")


def _count(pattern: str, c: Column) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("double")


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def _on_side(side: str, words: Column) -> Column:
    return F.transform(words, lambda w: F.struct(F.lit(side).alias("side"), w.alias("word")))


def features(found: DataFrame, learned: Learned, path_col: str = "source") -> DataFrame:
    """``found``, a staged table with a number ``fid`` for each candidate, with one column per feature."""
    v, before = F.col("value"), F.col("before")
    n, low, path = F.char_length(v).cast("double"), F.lower(v), F.lower(F.coalesce(F.col(path_col).cast("string"), F.lit("")))
    places = F.transform(F.split(low, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    table, width = F.lit(learned.pairs), len(ALPHABET) + 1
    pairs = F.transform(F.array(places), lambda p: F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(p) - 1, F.lit(1))), F.lit(0.0), lambda a, i: a + F.coalesce(
        F.try_element_at(table, F.element_at(p, i) * width + F.try_element_at(p, i + 1) + 1), F.lit(0.0))))[0]
    plain = found.withColumns({
        "length": n,
        "changes": (_count("[a-z](?=[A-Z0-9])", v) + _count("[A-Z](?=[0-9a-z])", v) + _count("[0-9](?=[A-Za-z])", v)) / n,
        "letter_pairs": pairs / F.greatest(n - 1, F.lit(1.0)),
        "distinct_share": F.size(F.array_distinct(F.split(v, ""))) / n,
        "digit_share": _count("[0-9]", v) / n,
        "upper_share": _count("[A-Z]", v) / n,
        "hex": _is(low.rlike("^[0-9a-f]+$")),
        **{name: _is(path.rlike(p)) for name, p in PATHS.items()},
        "path_depth": _count("/", path),
        "quoted": _is(before.rlike("[\"']$") & F.col("after").rlike("^[\"']")),
        "after_word": _is(F.col("after").rlike("^\\W*[a-z]{2,} ")),
    })
    camel = F.regexp_replace(v, "(?<=[a-z])(?=[A-Z])", " ")
    # words that the labelling rule reads are no neighbours
    aside = lambda c: F.regexp_replace(F.col(c), f"(?i){NAMES}|{PLACEHOLDERS}", " ")
    parts = {"own": _words(camel), "left": _words(aside("before")), "right": _words(aside("after"))}
    each = found.select("fid", F.explode(F.flatten(F.array(*[_on_side(k, words) for k, words in parts.items()]))).alias("p")).select("fid", "p.side", "p.word")
    known = each.groupBy("fid", "side", "word").agg(F.count(F.lit(1)).alias("times")).join(learned.words, "word", "left")
    hit, times = F.col("documents").isNotNull(), F.col("times")
    share = lambda side: (F.sum(F.when((F.col("side") == side) & hit, times).otherwise(0))
                          / F.greatest(F.sum(F.when(F.col("side") == side, times).otherwise(0)), F.lit(1)))
    sums = known.groupBy("fid").agg(F.sum(F.when((F.col("side") == "own") & hit, times * F.char_length("word")).otherwise(0)).alias("covered"),
                                    share("left").alias("words_before"), share("right").alias("words_after"))
    joined = plain.join(stage(sums, "neighbours"), "fid", "left")
    return joined.withColumns({"dictionary": F.coalesce(F.col("covered"), F.lit(0)) / F.col("length"), "words_before": F.coalesce("words_before", F.lit(0.0)),
                               "words_after": F.coalesce("words_after", F.lit(0.0))}).drop("covered")


def _luhn(v: Column) -> Column:
    digits = F.transform(F.split(F.reverse(v), ""), lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise(
        (2 * c.try_cast("int")) - F.when(c.try_cast("int") > 4, 9).otherwise(0)))
    return v.rlike("^[0-9]{13,19}$") & (F.aggregate(digits, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0)


def label_by_context(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1, 0, or null where the context decides nothing."""
    v, before = F.col("value"), F.lower("before")
    named, assigned = before.rlike(f"(?:{NAMES})\\W{{0,8}}$"), before.rlike("[=:]\\s*[\"']?$")
    made_up = before.rlike(f"(?:{PLACEHOLDERS})\\W{{0,8}}$")
    in_url = before.rlike("://[^\\s:/@\"']{1,64}:$") & F.col("after").startswith("@")
    quoted = before.rlike("[\"']$") & F.col("after").rlike("^[\"']")
    return found.withColumn("label", F.when(v.rlike(PREFIXES) | in_url, 1.0).when(named & assigned & ~made_up, 1.0)
                            .when(_luhn(v) | made_up, 0.0).when(~assigned & ~quoted & ~named, 0.0))


def label_by_review(found: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``found`` with ``label`` of reviewed findings ``labels(id, start, label)``: 1 a secret, 0 none, null elsewhere (and where reviews differ)."""
    agreed = (labels.select(F.col(id_col).alias("_d"), F.col("start").alias("_s"), F.col("label").cast("double").alias("_l")).where("_d IS NOT NULL")
              .groupBy("_d", "_s").agg(F.min("_l").alias("least"), F.max("_l").alias("label")).where("least = label AND label IN (0, 1)").drop("least"))
    return found.join(agreed, (F.col(id_col) == F.col("_d")) & (F.col("start") == F.col("_s")), "left").drop("_d", "_s")


def train(labelled: DataFrame, order: Column, limit: int = MAX_LABELLED) -> RandomForestClassificationModel | None:
    """A forest on at most ``limit`` labelled findings of each class, the first by ``order``; None without both classes."""
    rows = labelled.where("label IS NOT NULL")
    parts = [rows.where(F.col("label") == c).orderBy(order).limit(limit // 2) for c in (0.0, 1.0)]
    sample = stage(parts[0].union(parts[1]).select("label", *FEATURES), "labelled")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False)
    return forest.fit(_assembled(sample.coalesce(1).sortWithinPartitions(*FEATURES, "label")))


def _assembled(featured: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(featured)


def score(featured: DataFrame, model: RandomForestClassificationModel | None, removed_below: float = REMOVED_BELOW) -> DataFrame:
    """``featured`` with ``score`` (share of the forest for "secret") and ``secret``; without a forest ``secret`` follows ``label``."""
    if model is None:
        return featured.withColumns({"score": F.lit(None).cast("double"), "secret": F.col("label") == 1})
    scored = model.transform(_assembled(featured)).withColumn("score", F.round(vector_to_array("probability")[1], 9))
    return scored.drop("_x", "rawPrediction", "probability", "prediction").withColumn("secret", F.col("score") >= removed_below)


def held_out(labelled: DataFrame, order: Column, folds: int = 5) -> tuple[float, float] | None:
    """Precision and recall of a forest on one part in ``folds`` of the labelled findings, trained on the others; None if either part lacks a class."""
    part = F.pmod(F.xxhash64(order), F.lit(folds))
    rows = labelled.where("label IS NOT NULL").withColumn("_part", part)
    model = train(rows.where("_part <> 0").drop("_part"), order)
    if model is None:
        return None
    judged = score(rows.where("_part = 0").drop("_part"), model)
    r = judged.agg(*[F.count_if(c).alias(n) for n, c in (("hits", F.col("secret") & (F.col("label") == 1)), ("said", F.col("secret")), ("are", F.col("label") == 1))]).first()
    return (r.hits / r.said, r.hits / r.are) if r.said and r.are else None


def _scanned(rows: DataFrame, learned: Learned, labels: DataFrame | None) -> DataFrame:
    """All candidates of ``rows(doc_id, source, text, ...)`` with features, label, ``score`` and ``secret``."""
    keep = tuple(c for c in rows.columns if c != "text")
    found = candidates(rows, "text", keep).withColumn("fid", F.monotonically_increasing_id())
    found = stage(label_by_context(found) if labels is None else label_by_review(found, labels), "candidates")
    featured = stage(features(found, learned), "findings")
    return score(featured, train(featured, F.struct(F.xxhash64("doc_id", "start"), F.sha2("value", 256))))


def scan(docs: DataFrame, id_col: str = "doc_id", path_col: str = "source", text_col: str = "text", labels: DataFrame | None = None,
         least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """All candidates of ``docs`` (``doc_id``, ``source``, ``start``, ``value``, ...) with features, label, ``score`` and ``secret``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(path_col).alias("source"), F.col(text_col).alias("text"))
    reviewed = None if labels is None else labels.withColumnRenamed(id_col, "doc_id")
    return _scanned(rows, learn(docs, text_col, least_documents), reviewed)


def redact(docs: DataFrame, id_col: str = "doc_id", path_col: str = "source", text_col: str = "text", mark: str = "[SECRET]",
           labels: DataFrame | None = None) -> DataFrame:
    """``docs`` with the secrets that are kept as findings replaced by ``mark``; the same columns and rows.

    Only rows with a candidate are numbered, written aside and joined with their findings; the others pass through. A text is
    put together again from the pieces between its candidates, in time linear in its length.
    """
    uid, found = unused(docs, "row_number", "verdicts")
    suspect = F.coalesce(F.col(text_col).cast("string").rlike(FOUND), F.lit(False))
    held = stage(docs.where(suspect).withColumn(uid, F.monotonically_increasing_id()), "suspects")
    rows = held.select(F.col(id_col).alias("doc_id"), F.col(path_col).alias("source"), F.col(text_col).alias("text"), F.col(uid).alias("uid"))
    reviewed = None if labels is None else labels.withColumnRenamed(id_col, "doc_id")
    verdicts = (_scanned(rows, learn(docs, text_col), reviewed).groupBy(F.col("uid").alias(uid))
                .agg(F.array_sort(F.collect_list(F.struct("ordinal", "secret"))).alias(found)))
    text = F.col(text_col).cast("string")
    values = F.regexp_extract_all(text, F.lit(FOUND), F.lit(0))
    left = F.zip_with(values, F.col(found), lambda v, x: F.when(x.secret, F.lit(mark)).otherwise(v))
    joined = F.array_join(F.zip_with(F.split(text, FOUND, -1), left, lambda gap, v: F.concat(gap, F.coalesce(v, F.lit("")))), "")
    clean = held.join(verdicts, uid, "left").withColumn(
        text_col, F.when(F.exists(found, lambda x: x.secret), joined).otherwise(F.col(text_col)))
    return docs.where(~suspect).unionByName(clean.select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every candidate of all documents with its score and the forest's verdict; values as digests."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "start", F.char_length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"),
                        F.col("label").cast("int").alias("label"), "score", "secret")
