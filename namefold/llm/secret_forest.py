"""Secret scans: candidates by shape, a random forest against false positives. Built-in functions and Spark ML only.

A candidate is a run of at least ``SHORTEST`` characters of keys and tokens with a digit among them. Its features are
its length, the shares of its kinds of characters, how often the kind changes from one to the next, how many
characters differ, how much of it is made of dictionary words, whether it is part of a path or address, and the
neighbouring words and marks. The dictionary is the corpus itself: words counted over all documents, added up before
the exchange; a run of letters counts as a word if it stands alone at least ``DICTIONARY`` times.

The forest is trained from labelled findings ``(features, finding_label)``, a bounded sample of at most ``per_class``
of each label by a hash of the finding. Without a table of reviewed findings, ``context_labels`` labels those whose
surroundings leave no doubt: assigned to a name such as ``token`` or ``password`` is a secret, a number or a part of
an address without such a name is not. The rest stays unlabelled, and is what the forest decides.

Findings are one row each from the start, so long texts and documents with thousands of them are spread by Spark; the
dictionary is joined by distinct candidate, and a candidate that a third of all findings share is split by adaptive
execution, as both sides are written tables.

Nulls: a null or empty text has no candidates; a null doc_id stays null. Repeated rows give repeated findings, with
equal scores. Other columns are not needed. If only one label is found, every score is that label; without any
finding there is no row. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namefold.workspace import Workspace

SHORTEST = 16
AROUND = 48  # characters looked at on each side
DICTIONARY = 3
PER_CLASS = 4000
TREES, DEPTH, SEED = 20, 6, 11
SECRET_AT = 0.5

_KEY = "A-Za-z0-9_+/=-"
CANDIDATE = rf"(?<![{_KEY}])(?=[A-Za-z_+/=-]*[0-9])[{_KEY}]{{{SHORTEST},}}"
# Names that secrets are assigned to, and words beside harmless identifiers.
SECRET_NAMES = "token secret password passwd pwd apikey api_key api-key access_key private_key auth bearer credential".split()
HARMLESS = "commit sha md5 checksum hash digest uuid guid revision version build order invoice isbn card phone page id".split()

FEATURES = (
    "length digits upper lower marks changes variety words pathlike addressed named assigned quoted harmless".split()
)


def findings(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, candidate, before, after)``, one row per candidate; ``start`` counts characters from 0."""
    own = docs.select(
        "doc_id",
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("hits"),
        F.split("text", CANDIDATE, -1).alias("gaps"),
    ).filter(F.size("hits") > 0)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(
        F.zip_with("gaps", "hits", lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("hit"))),
        begin,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.coalesce(x["hit"], F.lit(0))).alias("at"),
            F.concat(acc["starts"], F.array(acc["at"] + x["gap"])).alias("starts"),
        ),
        lambda acc: acc["starts"],
    )
    each = F.transform(
        "hits",
        lambda h, i: F.struct(
            F.element_at("starts", i + 1).alias("start"),
            h.alias("candidate"),
            F.right(F.element_at("gaps", i + 1), F.lit(AROUND)).alias("before"),
            F.left(F.element_at("gaps", i + 2), F.lit(AROUND)).alias("after"),
        ),
    )
    return own.withColumn("starts", starts).select("doc_id", F.explode(each).alias("f")).select("doc_id", "f.*")


def _share(expression: str) -> Column:
    return F.regexp_count("candidate", F.lit(expression)) / F.length("candidate")


def _any_of(text: Column, words: list[str]) -> Column:
    return text.rlike(rf"(?i)(?<![A-Za-z])(?:{'|'.join(words)})(?![A-Za-z])").cast("double")


def dictionary_shares(found: DataFrame, docs: DataFrame, ws: Workspace) -> DataFrame:
    """``(candidate, words)``: the share of each distinct candidate that is made of words of the corpus."""
    runs = found.select("candidate").distinct()
    runs = runs.select("candidate", F.explode(F.regexp_extract_all("candidate", F.lit("[A-Za-z]{3,}"), F.lit(0))).alias("run"))
    runs, _ = ws.save(runs.withColumn("run", F.lower("run")), "runs")
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![\p{L}\p{N}])[a-z]{3,}(?![\p{L}\p{N}])"), F.lit(0))).alias("run"))
    known = words.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= DICTIONARY)
    known = known.join(runs.select("run").distinct(), "run", "left_semi").select("run")
    known, _ = ws.save(known, "dictionary")
    covered = runs.join(known, "run").groupBy("candidate").agg(F.sum(F.length("run")).alias("covered"))
    covered = covered.select("candidate", (F.col("covered") / F.length("candidate")).alias("words"))
    return ws.save(covered, "coverage")[0]


def with_features(found: DataFrame, docs: DataFrame, ws: Workspace) -> DataFrame:
    """Adds ``FEATURES``, all of them numbers."""
    found, _ = ws.save(found, "findings")
    near = F.col("before")
    kinds = F.lit("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])|[_+/=-](?=[^_+/=-])")
    found = found.join(dictionary_shares(found, docs, ws), "candidate", "left")
    return found.select(
        "doc_id", "start", "candidate", "before",
        F.length("candidate").cast("double").alias("length"),
        _share("[0-9]").alias("digits"),
        _share("[A-Z]").alias("upper"),
        _share("[a-z]").alias("lower"),
        _share("[_+/=-]").alias("marks"),
        (F.regexp_count("candidate", kinds) / F.length("candidate")).alias("changes"),
        (F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate")).alias("variety"),
        F.coalesce("words", F.lit(0.0)).alias("words"),
        F.greatest(near.rlike(r"[/\\.]$").cast("double"), _share("/[^/]*/")).alias("pathlike"),
        F.greatest(near.rlike(r"(?:://|www\.)\S*$").cast("double"), F.col("after").rlike(r"^\S*@|^\.[a-z]").cast("double")).alias("addressed"),
        _any_of(near, SECRET_NAMES).alias("named"),
        near.rlike("[:=]>?\\s*[\"'`]?$").cast("double").alias("assigned"),
        (near.rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("double").alias("quoted"),
        _any_of(near, HARMLESS).alias("harmless"),
    )


def context_labels(found: DataFrame) -> DataFrame:
    """Adds ``finding_label``: 1, 0, or null where the surroundings leave a doubt."""
    secret = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("harmless") == 0)
    harmless = (F.col("named") == 0) & (
        (F.col("digits") == 1) | (F.col("harmless") == 1) | (F.col("addressed") == 1) | (F.col("pathlike") > 0)
    )
    return found.withColumn("finding_label", F.when(secret, 1.0).when(harmless, 0.0))


def train(labelled: DataFrame, ws: Workspace, per_class: int = PER_CLASS) -> PipelineModel | float:
    """The forest, or the only label there is (0 without any)."""
    known = labelled.filter(F.col("finding_label").isNotNull()).select(
        *FEATURES, "finding_label", F.xxhash64("candidate", "before", F.lit(SEED)).alias("draw")
    )
    parts = [known.filter(F.col("finding_label") == y).orderBy("draw").limit(per_class) for y in (0.0, 1.0)]
    sample, _ = ws.save(parts[0].unionByName(parts[1]), "labelled")
    labels = sorted(r["finding_label"] for r in sample.select("finding_label").distinct().collect())
    if len(labels) < 2:
        return labels[0] if labels else 0.0
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(
        labelCol="finding_label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="chance"
    )
    ordered = assembler.transform(sample.orderBy("draw", *FEATURES)).select("features", "finding_label")
    return PipelineModel([assembler, forest.fit(ordered)])


def scan(docs: DataFrame, ws: Workspace, labelled: DataFrame | None = None) -> DataFrame:
    """``(doc_id, start, length, kind, masked, candidate_sha256, score, secret)``, one row per finding.

    ``labelled``: reviewed findings with ``FEATURES`` and ``finding_label``; by default those the context decides.
    """
    found, _ = ws.save(with_features(findings(docs), docs, ws), "features")
    model = train(context_labels(found) if labelled is None else labelled, ws)
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        scored = model.transform(found).withColumn("score", F.element_at(vector_to_array("chance"), 2))
    kind = (
        F.when(F.col("digits") == 1, "digits")
        .when(F.col("candidate").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(F.col("candidate").rlike("^[A-Za-z0-9+/]+=*$"), "base64")
        .otherwise("mixed")
    )
    return scored.select(
        "doc_id",
        "start",
        F.col("length").cast("int").alias("length"),
        kind.alias("kind"),
        F.concat(F.left("candidate", F.lit(4)), F.lit("...")).alias("masked"),
        F.sha2("candidate", 256).alias("candidate_sha256"),
        "score",
        (F.col("score") >= SECRET_AT).alias("secret"),
    )
