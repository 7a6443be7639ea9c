"""Secrets in texts: a wide pattern proposes, a random forest removes false positives.

Everything is DataFrame work. A candidate is a long run of letters, digits, ``_``, ``+``,
``/`` or ``-`` that has a digit; a word (minified JSON, a record of CSV) may hold many. What the forest sees of it: its length, the shares of digits, capitals and distinct
characters, how often the kind of character changes from one to the next, how much of it is
made of words that the corpus' documents use, what path it comes from, and the text in front of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import whole, written

# A run of 12 or more with a digit in it; the run is taken whole, so it is looked at once.
_SHAPE = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+"
# Ends of fields within a word: a name in front of one does not name what stands behind it.
_FIELD = r"[,;&?{}\[\]|]"
# Pieces of a word, and characters of each, that are looked at in front of a candidate: no row grows with its word.
_PIECES, _REACH = 3, 100
_WHITE = "[ \\t\\n\\x0B\\f\\r]+"
_NAMES = "pass|secret|token|key|auth|credential|bearer|pwd"
# Beginnings of issued keys.
_ISSUED = "^(AKIA|ASIA|ghp_|gho_|github_pat_|sk-|sk_live_|xox[abp]-|glpat-|AIza)"
_NUMBERS = ("length", "digits", "capitals", "distinct", "changes", "hex", "coverage", "path", "named_before", "named_in", "assigned", "issued")


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled findings that the forest learns from, at most, of each label those with the smallest hashes, half of the
    sample or what the other label leaves; ``known``: documents
    that have to use a word for it to be in the dictionary; ``threshold``: chance from which a finding is a secret."""

    sample: int = 5_000
    known: int = 3
    trees: int = 20
    depth: int = 6
    threshold: float = 0.5


def findings(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, position, place, candidate, lead, before, path) for every candidate of a text.

    ``position`` is the word's number from 0, ``place`` the candidate's number in its word, ``lead`` what stands in front of it
    in its field of the word, ``before`` the two words in front if it is in the word's first field, else empty. Null and empty
    texts have none. Repeated rows have the same findings twice; a null id or path stays null.
    """
    held = documents.select(F.col(doc_id).alias("doc_id"), F.col(path).cast("string").alias("path"), whole(text).alias("t")).where(F.col("t").rlike(_SHAPE))
    words = held.select("doc_id", "path", F.split("t", _WHITE).alias("w"))
    marked = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(_SHAPE))
    rows = words.select("doc_id", "path", "w", F.explode(marked).alias("m"))
    before = F.array_join(F.slice("w", F.greatest(F.lit(1), F.col("m.i") - 1), F.least(F.lit(2), F.col("m.i"))), " ")
    parts = rows.select("doc_id", "path", F.col("m.i").alias("position"), before.alias("before"), F.split("m.x", _SHAPE).alias("gaps"),
                        F.regexp_extract_all("m.x", F.lit(_SHAPE), F.lit(0)).alias("runs"))
    # Brackets that open the word end no field.
    ends = F.transform("gaps", lambda g, i: F.when(i == 0, g.rlike(f"(?s)[A-Za-z0-9_].*{_FIELD}")).otherwise(g.rlike(_FIELD)))
    parts = parts.withColumn("ended", F.array_position(ends, F.lit(True)))
    # Candidate i stands between gaps i and i + 1.
    near = [F.right(F.get("gaps", F.col("place") - k), F.lit(_REACH)) for k in range(_PIECES + 1)]
    runs = [F.right(F.get("runs", F.col("place") - k), F.lit(_REACH)) for k in range(1, _PIECES + 1)]
    pieces = [near[_PIECES], *(x for k in range(_PIECES, 0, -1) for x in (runs[k - 1], near[k - 1]))]
    lead = F.regexp_replace(F.concat(*(F.coalesce(x, F.lit("")) for x in pieces)), f"(?s)^.*{_FIELD}", "")
    first = (F.col("ended") == 0) | (F.col("ended") > F.col("place") + 1)
    each = parts.select("*", F.posexplode("runs").alias("place", "candidate"))
    return each.select("doc_id", "position", "place", "candidate", lead.alias("lead"), F.when(first, F.col("before")).otherwise("").alias("before"), "path")


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def described(found: DataFrame, documents: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """The findings with the numbers that the forest sees. Dictionary words are counted over all documents."""
    parts = F.array_distinct(F.filter(F.split(F.lower("candidate"), "[^a-z]+"), lambda x: F.length(x) >= 3))
    asked = found.select(F.explode(parts).alias("part")).distinct()
    used = documents.select(F.explode(F.array_distinct(F.split(F.lower(whole(text)), "[^a-z]+"))).alias("part"))
    known = used.groupBy("part").count().where(F.col("count") >= settings.known).join(asked, "part", "left_semi")
    # Candidates are few and repeat; each is covered once.
    pieces = found.select("candidate").distinct().select("candidate", F.explode(parts).alias("part"))
    covered = pieces.join(known, "part", "left_semi").groupBy("candidate").agg(F.sum(F.length("part")).alias("covered"))
    name, lead = F.lower("before"), F.lower("lead")
    return found.join(covered, "candidate", "left").select(
        *found.columns,
        F.length("candidate").cast("double").alias("length"), _share("[0-9]").alias("digits"), _share("[A-Z]").alias("capitals"),
        (F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate")).alias("distinct"),
        _share("[0-9](?=[^0-9])|[a-z](?=[^a-z])|[A-Z](?=[^A-Z])").alias("changes"),
        F.col("candidate").rlike("^[0-9a-f]+$").cast("double").alias("hex"),
        (F.coalesce("covered", F.lit(0)) / F.length("candidate")).alias("coverage"),
        F.pmod(F.xxhash64(F.coalesce("path", F.lit(""))), F.lit(16)).cast("double").alias("path_slot"),
        name.rlike(_NAMES).cast("double").alias("named_before"), lead.rlike(f"({_NAMES})[^=:]*[=:]").cast("double").alias("named_in"),
        F.expr("lead like '%=%' or before like '%=' or before like '%:'").cast("double").alias("assigned"),
        F.col("candidate").rlike(_ISSUED).cast("double").alias("issued"),
    )


def labelled_by_rule(rows: DataFrame) -> DataFrame:
    """Labels for described findings where none are given: issued beginnings and assignments to a telling name are
    secrets (1), bare words without such a name in front are not (0), all others stay unlabelled (null)."""
    sure = (F.col("issued") == 1) | (F.col("named_in") == 1) | ((F.col("named_before") == 1) & (F.col("assigned") == 1))
    plain = (F.col("named_before") == 0) & (F.col("assigned") == 0)
    return rows.withColumn("label", F.when(sure, 1.0).when(plain, 0.0))


def scan(documents: DataFrame, labelled: DataFrame | None = None, settings: Settings = Settings(), doc_id: str = "doc_id",
         text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, position, candidate, score, secret) for every candidate in the documents; ``position`` is its word's number from 0.

    ``labelled``: described findings with a ``label`` (1 or 0); without it the documents' own are labelled by rule.
    Where all labels are alike, those outside the sample included, there is nothing to tell apart and every candidate gets that label as its score;
    without any label, 0.5. An empty table gives an empty result.
    """
    rows = written(described(findings(documents, doc_id, text, path), documents, settings, text), "findings")
    labels = (labelled if labelled is not None else labelled_by_rule(rows)).where("label is not null")
    # Over all labels, not the sample's: one that is rare counts too.
    times = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    if len(times) < 2:
        scored = rows.withColumn("score", F.lit(float(next(iter(times), 0.5))))
    else:
        total, half = sum(times.values()), settings.sample // 2
        order = F.xxhash64("doc_id", "position", "candidate")
        parts = [labels.where(F.col("label") == k).orderBy(order).limit(max(half, settings.sample - total + n)) for k, n in times.items()]
        sample = written(parts[0].unionByName(parts[1]), "labels")
        numbers = [n if n != "path" else "path_slot" for n in _NUMBERS]
        vector = VectorAssembler(inputCols=numbers, outputCol="features")
        forest = RandomForestClassifier(labelCol="label", numTrees=settings.trees, maxDepth=settings.depth, seed=7)
        model = forest.fit(vector.transform(sample))
        scored = model.transform(vector.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "position", "candidate", "score", (F.col("score") >= settings.threshold).alias("secret"))
