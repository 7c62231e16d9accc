"""Document fingerprints by I-Match over several random parts of a lexicon.

The lexicon holds the terms whose inverse document frequency lies in a band: in at least
``MIN_SHARE`` and at most ``MAX_SHARE`` of all documents. The number of such terms is at
most the mean number of distinct terms of a document over ``MIN_SHARE``, whatever the
corpus, which is why it may be broadcast; its size is still looked at first. A document
keeps its distinct lexicon terms, sorted by their number, which is taken from a digest of
the term. Their digest is the first part of the fingerprint. The other parts are digests
of what is left when only a random part of the lexicon is kept: ``ROUNDS`` independent
choices, each thinned out by halves, so that long and short documents both have parts with
few terms, in which alone a likeness below equality can show.

Everything is built from DataFrame functions. Documents are moved once, into ranges of
their ids, where a window pairs each with the next one.

Defined cases: a null text is an empty one; null ids come last and among equal ids the
text decides; a document without lexicon terms has a digest of all its terms instead; the
only document is its own next one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslens.llm.common import materialise

MIN_SHARE = 0.0005
MAX_SHARE = 0.2
#: Least number of documents a lexicon term stands in.
MIN_DOCUMENTS = 2
#: Independent choices of a part of the lexicon; each uses eight bits of a term's number.
ROUNDS = 7
#: Of 256 values of those bits, a part keeps the terms below so many.
PARTS = (64, 32, 16, 8, 4, 2, 1)
#: Hexadecimal digits of the digest of a part; so many zeros stand for a part without terms.
DIGITS = 4
#: A lexicon of more terms than this is joined by shuffling, not by broadcast.
BROADCAST_TERMS = 2_000_000
NOT_A_TERM = "[^\\p{L}\\p{N}]+"


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), NOT_A_TERM))


def term_number(term: Column) -> Column:
    """56 bits of a term's digest."""
    return F.conv(F.substring(F.md5(F.encode(term, "utf-8")), 1, 2 * ROUNDS), 16, 10).cast("long")


def lexicon(texts: DataFrame) -> DataFrame:
    """(term, number) of the terms in the band."""
    documents = texts.count()
    counted = (
        texts.select(F.explode(terms_of(F.col("text"))).alias("term"))
        .where("term <> ''")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    least = max(float(MIN_DOCUMENTS), MIN_SHARE * documents)
    kept = counted.where((F.col("df") >= least) & (F.col("df") <= max(MAX_SHARE * documents, least)))
    return kept.select("term", term_number(F.col("term")).alias("number"))


def _digest(value: Column, digits: int) -> Column:
    return F.substring(F.md5(F.encode(value.cast("string"), "utf-8")), 1, digits)


def fingerprint(numbers: str, everything: str) -> Column:
    """The fingerprint from sorted term numbers, or from a digest of all terms if there are none."""
    limits = ", ".join(map(str, PARTS))
    kept = f"transform(sequence(0, {8 * (ROUNDS - 1)}, 8), s -> named_struct('s', s, 'k', filter({numbers}, x -> (shiftright(x, s) & 255) < {PARTS[0]})))"
    parts = f"flatten(transform({kept}, q -> transform(array({limits}), b -> filter(q.k, x -> (shiftright(x, q.s) & 255) < b))))"
    digests = f"transform({parts}, k -> if(size(k) = 0, '{'0' * DIGITS}', substring(md5(cast(k AS string)), 1, {DIGITS})))"
    some = F.concat(_digest(F.col(numbers), 16), F.expr(f"array_join({digests}, '')"))
    none = F.concat(everything, F.lit("0" * (DIGITS * ROUNDS * len(PARTS))))
    return F.when(F.size(numbers) > 0, some).otherwise(none)


def likeness(a: Column, b: Column) -> Column:
    """Of the parts in which either has terms, the share in which both have the same; 1 if equal."""
    zeros = F.lit("0" * DIGITS)
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(ROUNDS * len(PARTS) - 1)),
        lambda k: F.struct(
            F.substring(a, k * DIGITS + 17, F.lit(DIGITS)).alias("a"),
            F.substring(b, k * DIGITS + 17, F.lit(DIGITS)).alias("b"),
        ),
    )
    used = F.size(F.filter(pieces, lambda p: (p["a"] != zeros) | (p["b"] != zeros)))
    same = F.size(F.filter(pieces, lambda p: (p["a"] == p["b"]) & (p["a"] != zeros)))
    return F.when(a == b, F.lit(1.0)).when(used == 0, F.lit(0.0)).otherwise(same.cast("double") / used)


def in_ranges(texts: DataFrame) -> DataFrame:
    """(range, again, doc_id, text): documents by range of ids.

    There are as many ranges as shuffle partitions; their borders are quantiles of the ids,
    one number each. The first document of each range stands again in the range before it
    (``again``), as what follows there; the first of all also follows the last.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    borders = []
    if shares:
        borders = sorted(set(texts.agg(F.percentile_approx("doc_id", shares, 10_000)).head()[0] or []))
    within = F.when(F.col("doc_id").isNull(), F.lit(-1))
    if borders:
        list_of = F.lit(borders)
        within = within.otherwise(F.size(F.filter(list_of, lambda b: b < F.col("doc_id"))))
    else:
        within = within.otherwise(F.lit(0))
    ranged = texts.withColumn("range", within)
    heads = {r["range"]: r["head"] for r in ranged.groupBy("range").agg(F.max("doc_id").alias("head")).collect()}
    rows = ranged.withColumn("again", F.lit(False))
    if not heads:
        return rows
    order = sorted(heads, reverse=True)
    place = F.create_map(*[F.lit(x) for k, r in enumerate(order) for x in (r, order[k - 1])])
    ids = [h for h in heads.values() if h is not None]
    first = F.col("doc_id").isNull() if None in heads.values() else F.lit(False)
    if ids:
        first = F.coalesce(F.col("doc_id").isin(ids), F.lit(False)) | first
    repeated = ranged.where(first).withColumns({"again": F.lit(True), "range": place[F.col("range")]})
    return rows.unionByName(repeated)


def with_edits(documents: DataFrame) -> DataFrame:
    """Each document with the next one by falling id, and its text edited with that one's start."""
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    along = W.partitionBy("range").orderBy("again", F.desc_nulls_last("doc_id"), "text")
    rows = in_ranges(texts).withColumns(
        {"place": F.row_number().over(along), "next": F.lead("text").over(along), "n_chars": F.length("text").cast("long")}
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    start = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half)
    edited = F.concat(start, F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    return rows.withColumn("edited", edited).drop("next")


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    texts = documents.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    terms = materialise(lexicon(texts))
    # A term that every document has keeps documents without lexicon terms in the join.
    marker = documents.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(None).cast("long").alias("number"))
    known = terms.unionByName(marker)
    if terms.count() <= BROADCAST_TERMS:
        known = F.broadcast(known)
    sha = F.sha2(F.encode("edited", "utf-8"), 256)
    rows = with_edits(documents).select(
        "range", "place", "again", "doc_id", "n_chars", F.when(~F.col("again"), sha).alias("sha"), "text", "edited"
    )
    variants = F.array(
        F.struct(F.lit(0).alias("edit"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("edit"), F.when(~F.col("again"), F.col("edited")).alias("text")),
    )
    each = rows.select("range", "place", "again", "doc_id", "n_chars", "sha", F.explode(variants).alias("v")).select(
        "range", "place", "again", "doc_id", "n_chars", "sha", F.col("v.edit").alias("edit"), terms_of(F.col("v.text")).alias("terms")
    )
    # The digest is made below the explosion, once a text and not once a term.
    each = each.where("terms IS NOT NULL").withColumn(
        "everything", _digest(F.array_join(F.sort_array("terms"), " "), 16)
    )
    each = each.select(
        "range", "place", "again", "doc_id", "n_chars", "sha", "edit", "everything",
        F.explode(F.array_union("terms", F.array(F.lit("")))).alias("term"),
    )
    kept = each.join(known, "term")
    own = [F.when(F.col("edit") == k, F.col("number")) for k in (0, 1)]
    # Rows of a range are together already, so this grouping moves nothing.
    grouped = kept.groupBy("range", "place").agg(
        *[F.first(c).alias(c) for c in ("again", "doc_id", "n_chars", "sha")],
        *[F.sort_array(F.collect_set(x)).alias(f"numbers{k}") for k, x in enumerate(own)],
        *[F.first(F.when(F.col("edit") == k, F.col("everything")), ignorenulls=True).alias(f"all{k}") for k in (0, 1)],
    )
    marked = grouped.select(
        "range", "place", "again", "doc_id", "n_chars", F.col("sha").alias("edited_sha256"),
        fingerprint("numbers0", "all0").alias("fingerprint"),
        fingerprint("numbers1", "all1").alias("edited_fingerprint"),
    )
    following = F.lead("fingerprint").over(W.partitionBy("range").orderBy("place"))
    return (
        marked.withColumn("next", following)
        .where(~F.col("again"))
        .select(
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
        )
    )
