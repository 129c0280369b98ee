"""Document fingerprints: SimHash, DataFrame functions only.

Every pair of neighbouring words (lower-cased, split at white space) is a term;
each occurrence votes with its hash: plus its weight on the one bits, minus on
the others.  The weight is the term's length in characters (255 at most), so rare long terms
count more than pairs of short function words.  A fingerprint bit is the sign
of its sum.  Sums of all 64 bits are kept two to a number: ``(hash >> k) &
0x100000001`` holds bits k and k + 32; a text of less than 2**30 characters
(Spark's rows end there) has less than 2**31 votes, so neither half runs over.

``near_search`` finds all fingerprints within a Hamming radius: the 64 bits are
cut into radius + 2 blocks; two fingerprints within the radius agree on at
least two whole blocks, so one table per pair of blocks, keyed by their bits,
holds every neighbour.  Fingerprints of a key are packed into groups of bounded
size and queries meet groups, not single fingerprints; a neighbour counts only
in the first table in which it agrees, so none counts twice.

Defined cases: NULL or wordless text has fingerprint 0; a text of one word is
one term.  The next document is the one with the next smaller doc_id (after
the smallest, the largest); NULL doc_ids count as smallest; rows of equal
doc_id follow a hash of their text.  A single row is its own next.  Extra
columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverflow.llm.common import counted_broadcast, table
from riverflow.session import stage

RADIUS = 3
GROUP = 256          # fingerprints per packed group
SLICE_DOCS = 2_000   # least documents in one slice of the neighbour order
SLICES_PER_PARTITION = 4
HALVES = (1 << 32) | 1


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def terms(words: Column) -> Column:
    """Neighbouring word pairs, each packed into one number: its hash with the
    low byte replaced by its length (at most 255); one word alone is a term."""
    def pack(a, b, length):
        return F.xxhash64(a, b).bitwiseAND(~255).bitwiseOR(F.least(length, F.lit(255)).cast("long"))
    return F.when(F.size(words) > 1, F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
        lambda a, b: pack(a, b, F.char_length(a) + F.char_length(b)))
    ).otherwise(F.transform(words, lambda a: pack(a, F.lit(""), F.char_length(a))))


def fingerprints(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` (unique per row) with the 64-bit ``fingerprint`` of each text.
    If ``df`` is already distributed by some of the keys, nothing is shuffled."""
    # words are split in a projection of their own, so once per text
    words = df.select(*keys, split_words(F.col(text_col)).alias("words_"))
    words = words.select(*keys, F.explode_outer(terms(F.col("words_"))).alias("t_"))
    hashed = words.select(*keys, F.xxhash64("t_").alias("h_"),
                          F.coalesce(F.col("t_").bitwiseAND(255), F.lit(0)).alias("w_"))
    sums = hashed.groupBy(*keys).agg(F.sum("w_").alias("all_"), *[
        F.sum(F.shiftrightunsigned("h_", k).bitwiseAND(HALVES) * F.col("w_")).alias(f"s{k}_") for k in range(32)])
    bits = F.lit(0).cast("long")
    for k in range(32):
        low = F.col(f"s{k}_").bitwiseAND(0xFFFFFFFF)
        high = F.shiftrightunsigned(f"s{k}_", 32)
        for at, votes in ((k, low), (k + 32, high)):
            one = F.when(2 * votes > F.col("all_"), F.lit(1)).otherwise(F.lit(0)).cast("long")
            bits = bits.bitwiseOR(F.shiftleft(one, at))
    return sums.select(*keys, bits.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256 and fingerprints of the text, of
    its edited form (the last third replaced by as much of the next document's
    start) and the next document's.

    Documents are dealt once, in slices of neighbouring doc_ids, with the last
    document of each slice copied to the next; everything after that shuffle
    stays in its partition.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = base.count()
    # slice borders: doc_ids at equal ranks, a few slices per shuffle partition
    parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = max(1, min(-(-n // SLICE_DOCS), SLICES_PER_PARTITION * parts))
    borders = base.agg(F.percentile_approx("doc_id", [i / cuts for i in range(1, cuts)] or [0.5], 10 * cuts + 1000)
                       .alias("b")).first()[0] or []
    borders = sorted(set(borders)) if cuts > 1 else []
    listed = F.lit(borders).cast("array<long>") if borders else F.array().cast("array<long>")
    steps = F.array(*[F.lit(1 << k) for k in range(len(borders).bit_length() - 1, -1, -1)])

    def slice_of(doc_id):
        """Number of borders below the doc_id, by halving."""
        if not borders:
            return F.lit(0).cast("long")

        def halve(found, step):
            at = found + step
            return F.when((at <= len(borders)) & (F.get(listed, at - 1) < doc_id), at).otherwise(found)
        return F.aggregate(steps, F.lit(0), halve).cast("long")

    ids = stage(base.select("doc_id").withColumn("slice_", slice_of(F.col("doc_id"))).groupBy("slice_").agg(
        F.max("doc_id").alias("last_"), F.count(F.lit(1)).alias("n_")), "slices")
    # one row per slice: its last document is the next one's neighbour
    order = sorted(((r[0], r[1]) for r in ids.select("slice_", "last_").collect()))
    follow = {s: order[(i + 1) % len(order)][0] for i, (s, _) in enumerate(order)}
    slices = base.sparkSession.createDataFrame(
        [(s, last, follow[s]) for s, last in order], "s_ long, last_ long, to_ long")
    dealt = base.withColumn("slice_", slice_of(F.col("doc_id")))
    dealt = dealt.join(F.broadcast(slices), dealt.slice_ == slices.s_).select(
        "doc_id", "text", F.explode(F.when(
            F.col("doc_id").eqNullSafe(F.col("last_")),
            F.array(F.struct(F.col("slice_").alias("slice"), F.lit(False).alias("copy")),
                    F.struct(F.col("to_").alias("slice"), F.lit(True).alias("copy"))))
            .otherwise(F.array(F.struct(F.col("slice_").alias("slice"), F.lit(False).alias("copy"))))).alias("p_"))
    dealt = dealt.select(F.col("p_.slice").alias("slice_"), F.col("p_.copy").alias("copy_"), "doc_id", "text")
    w = Window.partitionBy("slice_").orderBy(F.desc("copy_"), F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    placed = dealt.withColumns({"next_": F.lag("text").over(w), "pos_": F.row_number().over(w)})
    n_chars = F.char_length("text")
    third = F.floor(n_chars / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - third),
                      F.substring(F.coalesce("next_", "text"), F.lit(1), third))
    placed = placed.withColumns({"n_chars": n_chars.cast("long"), "edited_": edited})
    placed = placed.withColumn("edited_sha256", F.sha2("edited_", 256))
    keys = ["slice_", "pos_", "copy_", "doc_id", "n_chars", "edited_sha256"]
    both = placed.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("edited"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("edited"), F.when(~F.col("copy_"), F.col("edited_")).alias("text")))).alias("v_"))
    prints = fingerprints(both.select(*keys, F.col("v_.edited").alias("v_"), F.col("v_.text").alias("text")),
                          [*keys, "v_"], "text")
    own = F.max(F.when(F.col("v_") == 0, F.col("fingerprint")))
    other = F.max(F.when(F.col("v_") == 1, F.col("fingerprint")))
    rows = prints.groupBy(*keys).agg(own.alias("fingerprint"), other.alias("edited_fingerprint"))
    w = Window.partitionBy("slice_").orderBy("pos_")
    rows = rows.withColumn("next_fingerprint", F.coalesce(F.lag("fingerprint").over(w), F.col("fingerprint")))
    return rows.where(~F.col("copy_")).drop("slice_", "pos_", "copy_")


def _tables(radius: int) -> list[tuple[int, ...]]:
    """Masks of the block pairs, one per table."""
    blocks, n = [], radius + 2
    for i in range(n):
        a, b = 64 * i // n, 64 * (i + 1) // n
        blocks.append(((1 << (b - a)) - 1) << a)
    masks = [x | y for x, y in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_search(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """For each distinct query ``fingerprint``: ``n_near``, the number of other
    distinct fingerprints of ``corpus`` within ``radius`` bits, and
    ``near_docs``, the rows that carry them.  ``corpus``: fingerprint, n."""
    masks = _tables(radius)
    table_keys = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(m).alias("key"))
                                     for t, m in enumerate(masks)])).alias("k_")
    have = corpus.select("fingerprint", "n", table_keys).select("fingerprint", "n", "k_.*")
    # a key's fingerprints in groups of about ``group``: no group grows with the key
    sizes = have.groupBy("t", "key").agg(F.ceil(F.count(F.lit(1)) / group).cast("long").alias("groups"))
    ask = queries.select("fingerprint").distinct().select(F.col("fingerprint").alias("q"), "fingerprint", table_keys)
    ask = ask.select("q", "k_.*").join(sizes, ["t", "key"])
    ask = ask.select("t", "key", "q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("g"))
    wanted = ask.select("t", "key").distinct()
    packed = (have.join(wanted, ["t", "key"]).join(sizes, ["t", "key"])
              .withColumn("g", F.pmod(F.xxhash64("fingerprint"), F.col("groups")))
              .groupBy("t", "key", "g").agg(F.collect_list(F.struct(F.col("fingerprint").alias("f"), "n")).alias("members")))
    met = ask.join(packed, ["t", "key", "g"])
    differ = lambda m: m["f"].bitwiseXOR(F.col("q"))

    def first_agreement(m):
        """The first table in which both agree."""
        out = F.lit(len(masks))
        for t in range(len(masks) - 1, -1, -1):
            out = F.when(differ(m).bitwiseAND(masks[t]) == 0, F.lit(t)).otherwise(out)
        return out

    near = F.filter("members", lambda m: (m["f"] != F.col("q")) & (F.bit_count(differ(m)) <= radius)
                    & (first_agreement(m) == F.col("t")))
    found = met.select("q", near.alias("near_"))
    return found.select("q", F.size("near_").cast("long").alias("c_"), F.aggregate(
        "near_", F.lit(0).cast("long"), lambda s, m: s + m["n"]).alias("d_")).groupBy("q").agg(
        F.sum("c_").alias("n_near"), F.sum("d_").alias("near_docs")).withColumnRenamed("q", "fingerprint")


def op1_simhash(spark, sf_dir):
    """Fingerprints of all documents and their edited texts; for documents whose
    doc_id is divisible by 20, also the number of other documents whose
    fingerprint lies within the radius (n_near; NULL for others)."""
    rows = stage(edited_fingerprints(table(spark, sf_dir, "documents")), "fingerprints")
    corpus = stage(rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")), "distinct_fingerprints")
    asked = rows.where(F.col("doc_id") % 20 == 0)
    found = stage(near_search(asked.select("fingerprint"), corpus).join(corpus, "fingerprint").select(
        F.col("fingerprint").alias("q_"), (F.col("near_docs") + F.col("n") - 1).alias("near_")), "near")
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    out = rows.join(counted_broadcast(found), (rows.fingerprint == found.q_) & (rows.doc_id % 20 == 0), "left")
    return out.select("doc_id", "n_chars", "edited_sha256", hexed("fingerprint").alias("fingerprint"),
                      hexed("edited_fingerprint").alias("edited_fingerprint"),
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
                      F.col("near_").alias("n_near"))
