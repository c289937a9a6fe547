"""Document fingerprints: SimHash with weighted terms, and permuted block tables that find all fingerprints within a Hamming radius.

Only DataFrame functions are used. A term is a word as it stands. Longer words tell more: a term's weight is its length less two, 1 at least and MAX_WEIGHT at
most. So a fingerprint depends on its text alone, and new documents leave the old ones' as they are. Each occurrence of a term adds its weight to the
bits that its hash (the first half of its MD5) has set and takes it from the others; a fingerprint bit is set if its sum is positive.

The 64 sums ride in 16 numbers with four fields each: a chunk of CHUNK_WORDS words cannot fill a field. Chunks of long texts are added up field by
field after that. A document's words never leave its partition: only its packed sums are grouped. A text and its edited version share the
sums of the words that the edit leaves alone.

A row's key is its doc_id with a hash of its text. The order of documents is found on keys alone, by ranges; a document's first code points then
go to the one before it, so that texts are shuffled once and a quarter of them once more. No task holds more than a range of keys.

The tables: 64 bits in BLOCKS blocks; two fingerprints within `radius` bits agree in at least BLOCKS - radius blocks. For each choice of so many blocks
one table holds every distinct fingerprint with those blocks moved to the front, and fingerprints with one front are compared. A pair is taken from the first table that
holds it. Fronts with many fingerprints are dealt over salts. Copies share one entry.

Cases: null text is empty; a text without words has fingerprint 0, which is compared like any other; rows with the same doc_id and text are one
document in the order, and each is returned; rows with one doc_id and several texts are ordered by
a hash of the text; rows without doc_id come first; a single document is its own next one; no documents give no rows; other columns are not read.
"""

from __future__ import annotations

import operator
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitewarden.session import stage

BITS = 64
RADIUS = 3
BLOCKS = 6
MAX_WEIGHT = 10
CHUNK_WORDS = 3200
LANES = 16
HOT_FRONT = 512
_BLANKS = "\t\n\x0b\x0c\r"
_FIELD = 1 << 16
_LANE_MASK = sum(1 << (16 * f) for f in range(4))
KEY = ["id", "h"]


def flat(text: Column) -> Column:
    """The text with every blank as a space."""
    for blank in _BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def term_hash(term: Column) -> Column:
    """The first 64 bits of the term's MD5."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, 16), 16, -10).cast("bigint")


def packed_votes(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Packed sums per (*keys, chunk) of the words of each piece (*keys, flat). Keys must tell the pieces apart."""
    words = pieces.select(*keys, F.posexplode(F.split("flat", " ")).alias("pos", "term"))
    weight = F.when(F.col("term") == "", 0).otherwise(F.least(F.greatest(F.length("term") - 2, F.lit(1)), F.lit(MAX_WEIGHT)))
    weighed = words.select(*keys, F.floor(F.col("pos") / CHUNK_WORDS).cast("int").alias("chunk"), weight.cast("bigint").alias("weight"), term_hash(F.col("term")).alias("hash"))
    lanes = [F.sum(F.col("weight") * F.shiftrightunsigned("hash", k).bitwiseAND(F.lit(_LANE_MASK))).alias(f"lane{k}") for k in range(LANES)]
    return weighed.groupBy(*keys, "chunk").agg(F.sum("weight").alias("total"), *lanes)


def signed_bits(packed: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, fp): the packed sums of each key added up, and the signs of their votes."""
    ones = [F.sum(F.shiftrightunsigned(f"lane{j % LANES}", 16 * (j // LANES)).bitwiseAND(F.lit(_FIELD - 1))).alias(f"bit{j}") for j in range(BITS)]
    summed = packed.groupBy(*keys).agg(F.sum("total").alias("total"), *ones)
    bits = [F.when(2 * F.col(f"bit{j}") > F.col("total"), F.lit(_signed(1 << j))).otherwise(F.lit(0)).cast("bigint") for j in range(BITS)]
    return summed.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, id, h, text): the key (id, h) is never null."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("h"), "text")


def in_order(rows: DataFrame) -> DataFrame:
    """One row per document, by ascending doc_id: (doc_id, id, h, n_chars, copies, next_id, next_h); the first one follows the last."""
    per_key = rows.groupBy("doc_id", *KEY).agg(F.first(F.length("text")).alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    sort_key = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    ranged = stage(per_key.repartitionByRange(*sort_key).withColumn("part", F.spark_partition_id()), "ranges")
    firsts = ranged.groupBy("part").agg(F.min_by(F.struct(*KEY), F.struct("doc_id", "h")).alias("first"))
    # one row per range: as many as partitions
    parts = Window.orderBy("part")
    around = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = firsts.select("part", F.coalesce(F.lead("first").over(parts), F.first("first").over(around)).alias("follow"))
    inside = F.lead(F.struct(*KEY)).over(Window.partitionBy("part").orderBy(*sort_key))
    linked = ranged.withColumn("inside", inside).join(F.broadcast(follow), "part")
    following = F.coalesce("inside", "follow")
    return linked.select("doc_id", *KEY, F.col("n_chars").cast("bigint").alias("n_chars"), "copies", following["id"].alias("next_id"), following["h"].alias("next_h"))


def edited_texts(rows: DataFrame, order: DataFrame) -> DataFrame:
    """(id, h, kept, rest, head): each text in two, and the first code points of the next one that its edited version has in place of the rest, a quarter of it."""
    texts = rows.groupBy(*KEY).agg(F.first("text").alias("text"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    asks = order.select(F.col("next_id").alias("id"), F.col("next_h").alias("h"), quarter.alias("asked"), F.col("id").alias("asker_id"), F.col("h").alias("asker_h"))
    heads = texts.join(asks, KEY).select(F.col("asker_id").alias("id"), F.col("asker_h").alias("h"), F.expr("left(text, asked)").alias("head"))
    cut = texts.withColumn("n_kept", F.length("text") - F.floor(F.length("text") / 4).cast("int"))
    halves = cut.select(*KEY, F.expr("left(text, n_kept)").alias("kept"), F.expr("substring(text, n_kept + 1)").alias("rest"))
    return halves.join(heads, KEY)


def edited_prints(texts: DataFrame) -> DataFrame:
    """(id, h, sha, fp, edited_fp) of edited_texts: the last word of the kept part may go on in what follows, so it is counted there."""
    edited = F.concat("kept", "head")
    begun = texts.select(*KEY, F.unhex(F.sha2(edited.cast("binary"), 256)).alias("sha"), flat(F.col("kept")).alias("kept"), flat(F.col("rest")).alias("rest"), flat(F.col("head")).alias("head"))
    begun = begun.withColumn("last", F.substring_index("kept", " ", -1))
    shared = F.expr("left(kept, length(kept) - length(last))")
    pieces = begun.select(*KEY, "sha", F.posexplode(F.array(shared, F.concat("last", "rest"), F.concat("last", "head"))).alias("piece", "flat"))
    packed = packed_votes(pieces, [*KEY, "sha", "piece"])
    # the shared piece counts for both versions
    versions = F.when(F.col("piece") == 0, F.array(F.lit(0), F.lit(1))).when(F.col("piece") == 1, F.array(F.lit(0))).otherwise(F.array(F.lit(1)))
    prints = signed_bits(packed.withColumn("version", F.explode(versions)), [*KEY, "sha", "version"])
    of_version = [F.max(F.when(F.col("version") == v, F.col("fp"))) for v in (0, 1)]
    return prints.groupBy(*KEY, "sha").agg(of_version[0].alias("fp"), of_version[1].alias("edited_fp"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""
    rows = keyed(docs)
    pieces = rows.groupBy(*KEY).agg(F.first("text").alias("text")).select(*KEY, flat(F.col("text")).alias("flat"))
    return rows.select("doc_id", *KEY).join(signed_bits(packed_votes(pieces, KEY), KEY), KEY).select("doc_id", "fp")


def _masks(radius: int, blocks: int) -> list[int]:
    """The bits that each table has in front."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError(f"radius {radius} needs more than that many blocks, {blocks} given")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [_signed(reduce(operator.or_, chosen)) for chosen in combinations(parts, blocks - radius)]


def near_pairs(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(a, b, n_a, n_b, bits), a < b, of all pairs within `radius` bits among distinct fingerprints (fp, n)."""
    masks = _masks(radius, blocks)
    fronts = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("front")) for t, m in enumerate(masks)]))
    entries = prints.select("fp", "n", fronts.alias("e")).select("fp", "n", "e.t", "e.front")
    hot = entries.groupBy("t", "front").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > HOT_FRONT)
    hot = stage(hot, "hot_fronts")
    salts = F.coalesce(F.ceil(F.col("size") / HOT_FRONT), F.lit(1)).cast("int")
    entries = entries.join(hot, ["t", "front"], "left").withColumn("salts", salts).drop("size")
    left = entries.select("t", "front", F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int").alias("salt"), F.col("fp").alias("a"), F.col("n").alias("n_a"))
    right = entries.select("t", "front", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("fp").alias("b"), F.col("n").alias("n_b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(*[F.when(differing.bitwiseAND(F.lit(m)) == 0, t) for t, m in enumerate(masks)])
    near = (left.t == right.t) & (left.front == right.front) & (left.salt == right.salt) & (F.col("a") < F.col("b")) & (F.bit_count(differing) <= radius) & (first == left.t)
    return left.join(right, near).select("a", "b", "n_a", "n_b", F.bit_count(differing).alias("bits"))


def neighbours(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(fp, n_near): for each distinct fingerprint of `prints` (fp) the other rows within `radius` bits, copies included."""
    distinct = stage(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "prints")
    pairs = near_pairs(distinct, radius, blocks)
    ends = F.explode(F.array(F.struct(F.col("a").alias("fp"), F.col("n_b").alias("n_near")), F.struct(F.col("b").alias("fp"), F.col("n_a").alias("n_near"))))
    sums = pairs.select(ends.alias("e")).groupBy("e.fp").agg(F.sum("e.n_near").alias("more"))
    return distinct.join(sums, "fp", "left").select("fp", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_near"))


def likeness(a: Column, b: Column) -> Column:
    """The cosine of the weighted term vectors as two fingerprints tell it; 0 from half of the bits on."""
    return F.round(F.greatest(F.lit(0.0), F.cos(F.bit_count(a.bitwiseXOR(b)) * F.lit(3.141592653589793 / BITS))), 6)


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def with_edits(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next, n_near) of every row."""
    rows = keyed(docs)
    order = stage(in_order(rows), "order")
    prints = stage(edited_prints(edited_texts(rows, order)), "edited_prints")
    nexts = prints.select(F.col("id").alias("next_id"), F.col("h").alias("next_h"), F.col("fp").alias("next_fp"))
    found = order.join(prints, KEY).join(nexts, ["next_id", "next_h"])
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    near = neighbours(found.select("fp"), radius)
    return found.join(near, "fp").select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        "fp",
        "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_near",
    )
