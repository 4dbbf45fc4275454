"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions only.

A text's sketch keeps every hash of its five-word shingles that lies below a
fixed fraction of all hash values, one in ``FRACTION``, so sketches grow with their
texts and can be merged and compared however unequal the texts are.  ``threshold``
is the fraction's greatest hash: sketches of several fractions are compared up to
the lesser one.  ``least`` is the least of all hashes of the text, below the
threshold or not: it tells texts apart whose sketches have no hash.

An estimate of a part s of n shingles has a standard error of about
sqrt(s (1 - s) (FRACTION - 1) / n): with one in three kept 0.07 at s = 0.5 and
n = 100, 0.03 at n = 500.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import next_in_group

LEAST = -(1 << 63)
#: One of ``FRACTION`` hash values lies below the cut.
FRACTION, K = 3, 5
CUT = LEAST + (1 << 64) // FRACTION - 1


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, cut: int = CUT) -> DataFrame:
    """``df`` with the sketch of column ``text``: a struct ``name`` of ``threshold``, ``least`` and sorted ``hashes``.

    Null counts as empty; a text without words has no hash, and ``least`` is null.
    A text of fewer than ``k`` words has one shingle, its whole sequence.  Each
    step is a projection of its own, so that no array is computed twice."""
    tmp = [f"_{name}_{i}" for i in range(2)]
    blank = "[ \\t\\n\\x0B\\f\\r]+"
    trimmed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"^{blank}|{blank}$", "")
    df = df.withColumn(tmp[0], F.split(trimmed, blank))
    words = F.col(tmp[0])
    n = F.size(words)
    each = F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(k))))
    none = F.array().cast("array<bigint>")
    df = df.withColumn(tmp[1], F.when(n >= k, each).when((n == 1) & (words[0] == ""), none).otherwise(F.array(F.xxhash64(words)))).drop(tmp[0])
    kept = F.array_sort(F.array_distinct(F.filter(tmp[1], lambda h: h <= F.lit(cut))))
    return df.withColumn(name, F.struct(F.lit(cut).cast("long").alias("threshold"), F.array_min(tmp[1]).alias("least"), kept.alias("hashes"))).drop(tmp[1])


def _common(a: Column, b: Column) -> tuple[Column, Column]:
    """Hashes of either sketch up to the threshold of both."""
    both = F.least(a["threshold"], b["threshold"])
    return F.filter(a["hashes"], lambda h: h <= both), F.filter(b["hashes"], lambda h: h <= both)


def likeness(a: Column, b: Column) -> Column:
    """Estimated shared part of all shingles of two texts (0 to 1).  Where neither has a hash to compare:
    1 if the least hashes are equal (or neither text has a word), else 0."""
    x, y = _common(a, b)
    both = F.size(F.array_intersect(x, y))
    total = F.size(x) + F.size(y) - both
    return F.when(total > 0, both / total).otherwise(a["least"].eqNullSafe(b["least"]).cast("double"))


def containment(a: Column, b: Column) -> Column:
    """Estimated part of a's shingles that b has too (0 to 1).  Where a has no hash to compare: 1 if a has
    no word or the least hashes are equal, else 0."""
    x, y = _common(a, b)
    return F.when(F.size(x) > 0, F.size(F.array_intersect(x, y)) / F.size(x)).otherwise((a["least"].isNull() | a["least"].eqNullSafe(b["least"])).cast("double"))


def merged(a: Column, b: Column) -> Column:
    """Sketch of two texts' shingles together."""
    x, y = _common(a, b)
    return F.struct(F.least(a["threshold"], b["threshold"]).alias("threshold"), F.least(a["least"], b["least"]).alias("least"), F.array_sort(F.array_union(x, y)).alias("hashes"))


def as_text(sketch: Column) -> Column:
    """Least hash and hashes in hexadecimal; equal sketches have equal fingerprints."""
    return F.concat_ws(":", F.coalesce(F.hex(sketch["least"]), F.lit("")), F.array_join(F.transform(sketch["hashes"], lambda h: F.hex(h)), ","))


def next_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, need, next_id, next_hash) of every id: the next lesser id (that of the least id is the greatest),
    and the hash that marks the text which stands for that id where several rows have it; ``need`` is
    half of the code points of the id's longest text.  Only ids, lengths and hashes are sorted."""
    ids = docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.floor(F.length(text_col) / 2)).alias("need"), F.min(F.xxhash64(text_col)).alias("mark"))
    ranked = next_in_group(ids, [], [F.col("id").desc()], ["id", "mark"])
    first = ids.agg(F.max("id").alias("id"), F.max_by("mark", "id").alias("mark")).first()
    last = ~F.col("next_exists")
    return ranked.select("id", "need", F.when(last, F.lit(first["id"])).otherwise(F.col("next_id")).cast("long").alias("next_id"),
                         F.when(last, F.lit(first["mark"])).otherwise(F.col("next_mark")).cast("long").alias("next_mark"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, sketch, edited_sketch, next_sketch) of every row of ``docs``.

    ``edited`` is the text with its last floor(n_chars / 2) code points replaced
    by the first as many (or all) of the next document in descending order of id;
    after the last comes the first.  Null texts are empty.  A null id has no next
    document: the empty text stands for it.  Where rows share an id, each is
    edited, and the text of the least hash stands for the id as a next document."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = rows.filter("id IS NOT NULL")
    order = next_documents(named, "id", "text").withColumnRenamed("id", "owner")
    # the mark is no join key, so that both joins use one exchange of the texts by id
    marked = F.xxhash64("text").bitwiseXOR(order["next_mark"]) == 0
    following = named.join(order, named["id"] == order["next_id"]).filter(marked)
    following = with_sketch(following.select("owner", "need", "text"), "text", "next_sketch")
    following = following.select("owner", F.left("text", F.col("need").cast("int")).alias("head"), "next_sketch")
    if not rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        following = following.dropDuplicates(["owner"])  # these rows are equal
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    out = named.join(following, named["id"] == following["owner"]).drop("owner").unionByName(rows.filter("id IS NULL"), allowMissingColumns=True)
    out = out.select("id", "text", n.cast("long").alias("n_chars"), F.concat(F.left("text", n - half), F.left(F.coalesce("head", F.lit("")), half)).alias("edited"), "next_sketch")
    out = with_sketch(with_sketch(out, "text", "sketch"), "edited", "edited_sketch")
    nothing = F.struct(F.lit(CUT).cast("long").alias("threshold"), F.lit(None).cast("long").alias("least"), F.array().cast("array<bigint>").alias("hashes"))
    return out.select(F.col("id").alias(id_col), "n_chars", "edited", "sketch", "edited_sketch", F.coalesce("next_sketch", nothing).alias("next_sketch"))
