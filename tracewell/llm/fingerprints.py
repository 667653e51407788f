"""Document fingerprints: one-permutation MinHash with optimal densification, b-bit values; DataFrame functions only.

Every shingle is hashed once. The upper bits of the hash name a bin, the smallest hash of a bin stands for
it. An empty bin borrows from the first non-empty bin of a random order of its own, the same in every
document. Only the low-order bits are stored; likeness corrects for their chance agreement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BIN_BITS = 7
LOW_BITS = 8
SHINGLE = 5
EARLY = 8  # attempts written out one by one; all later ones are made only if these fail
BLANKS = " \t\n\x0b\f\r"


def _donor(bin_number: Column, attempt: Column, bins: int) -> Column:
    """The bin that an empty bin asks at its n-th attempt: a walk of odd stride, so that all bins are asked once."""
    h = F.xxhash64(bin_number)
    stride = F.shiftright(h, 20).bitwiseAND(F.lit(bins - 1)).bitwiseOR(F.lit(1))
    return ((h.bitwiseAND(F.lit(bins - 1)) + stride * attempt).bitwiseAND(F.lit(bins - 1))).cast("int")


def with_signature(df: DataFrame, text: str, name: str, shingle: int = SHINGLE, bin_bits: int = BIN_BITS,
                   low_bits: int = LOW_BITS) -> DataFrame:
    """Add ``name``: the low-order bits of every bin (array of int), empty for a text without words.

    Words are runs without ASCII white space, compared as they are; a text of fewer than ``shingle`` words is one
    shingle. Each step is a column of its own, so that lambdas refer to finished arrays.
    """
    bins = 1 << bin_bits
    w, s, f, d = (f"__tw_{name}_{x}" for x in "wsfd")
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - bin_bits)
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(BLANKS))
    hashed = F.transform(F.split(trimmed, r"[ \t-\r]+"), lambda x: F.xxhash64(x))
    df = df.withColumn(w, F.when(trimmed != "", hashed).otherwise(F.array().cast("array<bigint>")))
    joined = F.transform(F.col(w), lambda x, i: F.xxhash64(x, *[F.get(F.col(w), i + k) for k in range(1, shingle)]))
    count = F.greatest(F.size(w) - F.lit(shingle - 1), F.least(F.size(w), F.lit(1)))
    df = df.withColumn(s, F.sort_array(F.slice(joined, F.lit(1), count)))
    # sorted, the first hash of each bin is its smallest
    df = df.withColumn(f, F.filter(F.col(s), lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(s), i - 1)))))
    places = F.transform(F.col(f), lambda x: bin_of(x).cast("int"))
    df = df.withColumn(f + "_at", places)
    dense = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)),
                        lambda j: F.get(F.col(f), F.array_position(F.col(f + "_at"), j).cast("int") - 1))
    df = df.withColumn(d, F.when(F.size(f + "_at") > 0, dense))
    ask = lambda j, t: F.get(F.col(d), _donor(j, t, bins))
    later = lambda j: F.get(F.filter(F.transform(F.sequence(F.lit(EARLY), F.lit(bins - 1)), lambda t: ask(j, t)),
                                     lambda v: v.isNotNull()), F.lit(0))
    filled = F.transform(F.col(d), lambda x, j: F.coalesce(x, *[ask(j, F.lit(t)) for t in range(EARLY)], later(j)))
    low = F.transform(filled, lambda x: x.bitwiseAND(F.lit((1 << low_bits) - 1)).cast("int"))
    return df.withColumn(name, F.coalesce(low, F.array().cast("array<int>"))).drop(w, s, f, f + "_at", d)


def packed(signature: Column, low_bits: int = LOW_BITS) -> Column:
    """The stored form: the bits of all bins as one hexadecimal string."""
    digits = -(-low_bits // 4)
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), digits, "0")), "")


def likeness(a: Column, b: Column, low_bits: int = LOW_BITS) -> Column:
    """Estimated resemblance of two signatures, 0 to 1.

    Two unlike values agree in their low bits with chance 2^-b; the share of agreeing bins is corrected for it.
    Texts without words are like each other (1) and unlike all others (0).
    """
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda z: z)) / F.size(a)
    chance = 2.0 ** -low_bits
    estimate = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
            .otherwise(estimate))


def with_next(df: DataFrame, bounds: list[int], columns: list[str]) -> DataFrame:
    """Add ``next_<column>`` of the row with the next doc_id (after the last: the first), without a global sort.

    ``bounds`` are ids that occur, ascending from the smallest; each opens a range. The first row of a range is also
    put at the end of the range before it, so every range finds all its followers by itself.
    """
    if not bounds:
        bounds = [0]
    n = len(bounds)
    cuts = F.array(*[F.lit(b).cast("long") for b in bounds])
    place = F.greatest(F.size(F.filter(cuts, lambda b: b <= F.coalesce("doc_id", F.lit(bounds[0])))) - 1, F.lit(0))
    placed = df.withColumn("__tw_range", place)
    opens = F.col("doc_id").eqNullSafe(F.get(cuts, F.col("__tw_range")))
    copies = F.when(opens, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    copied = placed.withColumn("__tw_guard", F.explode(copies)).withColumn(
        "__tw_range", F.when(F.col("__tw_guard"), F.pmod(F.col("__tw_range") - 1, F.lit(n))).otherwise(F.col("__tw_range")))
    order = Window.partitionBy("__tw_range").orderBy("__tw_guard", "doc_id", *columns)
    for c in columns:
        copied = copied.withColumn(f"next_{c}", F.lead(c).over(order))
    return copied.where(~F.col("__tw_guard")).drop("__tw_guard", "__tw_range")


def compare_edited(docs: DataFrame, bounds: list[int], shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of all texts and of edited texts, with their likeness; see the query's contract.

    The last quarter of a text is replaced by the beginning of the next document. ``docs`` needs ``doc_id`` and
    ``text``; other columns are ignored. Null texts count as empty; a text under four characters stays as it is.
    Rows with one id follow each other in order of their texts; rows with a null id come first. The last row's next
    one is the first. An empty table gives an empty result.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    signed = with_signature(base, "text", "signature", shingle)
    chained = with_next(signed, bounds, ["text", "signature"]).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut),
                      F.substring("next_text", F.lit(1), cut))
    chained = chained.withColumn("edited", edited).drop("text", "next_text")
    both = with_signature(chained, "edited", "edited_signature", shingle)
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       packed(F.col("signature")).alias("fingerprint"), packed(F.col("edited_signature")).alias("edited_fingerprint"),
                       likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
                       likeness(F.col("signature"), F.col("next_signature")).alias("near_next"))
