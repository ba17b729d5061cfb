"""Document fingerprints: a Merkle tree over paragraphs and sections, with DataFrame functions only.

A paragraph ends after a line break or the end of a sentence, so where paragraphs end depends on the text right there alone and an edit moves no
other end. A paragraph of more than LONG characters is cut after words whose checksum says so, one in eight, and what is longer even then
after every PIECE characters. A section ends after a paragraph whose digest says so, one in eight. A paragraph's digest is of its text, a section's of
its paragraphs' digests, of 128 bits each, and the root's of the sections' digests, of 256 bits. The fingerprint is

    root:section=paragraph-length.paragraph-length/section=paragraph-length...

with the first 48 bits of the digests below the root, and lengths in hexadecimal. Equal roots mean equal texts; where roots differ, the sections that differ lead
to the paragraphs that do, and with their lengths to the place of an edit. The share of text that two documents have in common shows from their fingerprints alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterweave.llm.common import table

PARAGRAPH = r"(?<=[.!?。！？]\s)|(?<=\n)"
LONG, PIECE = 256, 128
ROOT_HEX, NODE_HEX, SHOWN_HEX = 64, 32, 12
#: The last digit of a paragraph's digest that ends a section: one in eight.
SECTION_END = ("0", "8")
ROWS_IN_BUCKET = 2048
#: Most ranges of ids by count, and how many of them a coarse one holds.
RANGES, FINE = 4096, 64
EMPTY = "cast(array() as array<string>)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is made once; a Column that a lambda names is otherwise made for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces(paragraph: Column) -> Column:
    """An over-long paragraph, cut after words by their checksum; what has no such words, after characters by the checksum of the three before the cut, so that an insertion moves cuts near it alone; what
    has no such characters either, one sign over and over, after every PIECE of them."""

    def cut(units: Column, ends_here: Callable[[Column], Column]) -> Column:
        last = F.size(units) - 1
        ends = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | ends_here(i))
        before = lambda ends, k: F.coalesce(F.get(ends, k - 1), F.lit(-1))
        return let(ends, lambda ends: F.transform(ends, lambda e, k: F.array_join(F.slice(units, before(ends, k) + 2, e - before(ends, k)), "")))

    def whole(long_: Column, further: Callable[[Column], Column]) -> Column:
        return F.flatten(F.transform(long_, lambda p: F.when(F.length(p) <= LONG, F.array(p)).otherwise(further(p))))

    by_words = let(F.split(paragraph, r"(?<=\s)"), lambda words: cut(words, lambda i: F.crc32(F.get(words, i)) % 8 == 0))
    three = lambda signs, i: F.crc32(F.concat(F.get(signs, i - 2), F.get(signs, i - 1), F.get(signs, i)))
    by_signs = lambda p: let(F.regexp_extract_all(p, F.lit("(?s)."), F.lit(0)), lambda signs: cut(signs, lambda i: (i >= 2) & (F.get(signs, i - 1) != F.get(signs, i)) & (three(signs, i) % 64 == 0)))
    return whole(by_words, lambda p: whole(by_signs(p), lambda q: F.regexp_extract_all(q, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))))


def paragraphs(text: Column) -> Column:
    parts = F.transform(F.split(text, PARAGRAPH), lambda p: F.when(F.length(p) <= LONG, F.array(p)).otherwise(pieces(p)))
    return F.filter(F.flatten(parts), lambda p: p != "")


def section_strings(text: Column) -> Column:
    """Each section as its paragraphs' digests and lengths, with a point behind each; no point behind the last of a section that a digest ends."""
    leaves = F.transform(paragraphs(text), lambda p: F.concat(F.md5(p), F.lit("-"), F.lower(F.hex(F.length(p)))))
    marked = F.transform(leaves, lambda d: F.concat(d, F.when(F.substring(d, NODE_HEX, 1).isin(*SECTION_END), "/").otherwise(".")))
    return F.filter(F.split(F.array_join(marked, ""), "/"), lambda s: s != "")


def fingerprint(sections: Column) -> Column:
    """From section_strings()."""
    shown = lambda s: F.array_join(F.transform(F.split(F.rtrim(s, F.lit(".")), r"\."), lambda d: F.concat(F.substring(d, 1, SHOWN_HEX), F.substring(d, NODE_HEX + 1, 16))), ".")
    nodes = F.transform(sections, lambda s: F.concat(F.substring(F.md5(s), 1, SHOWN_HEX), F.lit("="), shown(s)))
    root = F.sha2(F.array_join(F.transform(sections, F.md5), "").cast("binary"), 256)
    return F.concat(root, F.lit(":"), F.array_join(nodes, "/"))


def sections_of(print_: Column) -> Column:
    """The sections of a fingerprint, each as its digest, an equals sign and its paragraphs."""
    return F.filter(F.split(F.substring(print_, ROOT_HEX + 2, 1 << 30), "/"), lambda s: s != "")


def paragraphs_of(sections: Column) -> Column:
    """The paragraphs of sections, each as its digest and length."""
    return F.flatten(F.transform(sections, lambda s: F.split(F.substring(s, SHOWN_HEX + 2, 1 << 30), r"\.")))


def told_apart(paragraphs_: Column) -> Column:
    """The paragraphs with a number behind each, 1 and up among equal ones, so that sets of them count repetitions."""

    def numbered(ordered: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        copies = lambda starts, s, k: F.transform(F.sequence(F.lit(1), F.coalesce(F.get(starts, k + 1), F.size(ordered)) - s), lambda c: F.concat(F.get(ordered, s), F.lit("#"), c.cast("string")))
        return let(starts, lambda starts: F.flatten(F.transform(starts, lambda s, k: copies(starts, s, k))))

    return F.when(F.size(paragraphs_) == 0, paragraphs_).otherwise(let(F.array_sort(paragraphs_), numbered))


def total_length(paragraphs_: Column) -> Column:
    return F.aggregate(paragraphs_, F.lit(0).cast("bigint"), lambda n, x: n + F.conv(F.substring_index(F.substring(x, SHOWN_HEX + 2, 20), "#", 1), 16, 10).cast("bigint"))


def likeness(a: Column, b: Column, a_told: Column, b_told: Column) -> Column:
    """1 for equal fingerprints, otherwise the length of the paragraphs that both have, as often as both have them, over the larger total length.

    a_told, b_told: told_apart() of their paragraphs.
    """
    most = F.greatest(total_length(a_told), total_length(b_told))
    return F.when(a == b, 1.0).when(most == 0, 0.0).otherwise(total_length(F.array_intersect(a_told, b_told)) / most)


def agreeing(a: Column, b: Column) -> Column:
    """How many elements two arrays begin with in common."""
    least = F.least(F.size(a), F.size(b))
    return let(least, lambda n: F.when(n == 0, 0).otherwise(F.coalesce(F.array_min(F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(a, i) != F.get(b, i))), n)))


def edit(a_sections: Column, b_sections: Column) -> Column:
    """Where the second document differs from the first, as a struct of start and end among its characters: from the root to the first and the last section that differ, and within these to the paragraphs."""

    def within(s: Column, n: Column) -> Column:
        return F.when(F.get(s, n).isNull(), F.expr(EMPTY)).otherwise(paragraphs_of(F.array(F.get(s, n))))

    def common(a: Column, b: Column) -> Column:
        inside = lambda x, y: total_length(F.slice(y, F.lit(1), agreeing(x, y)))
        return let(agreeing(a, b), lambda n: total_length(paragraphs_of(F.slice(b, F.lit(1), n))) + let(within(a, n), lambda x: let(within(b, n), lambda y: inside(x, y))))

    def backwards(s: Column) -> Column:
        return F.transform(F.reverse(s), lambda x: F.concat(F.substring(x, 1, SHOWN_HEX + 1), F.array_join(F.reverse(F.split(F.substring(x, SHOWN_HEX + 2, 1 << 30), r"\.")), ".")))

    def ends(a: Column, b: Column) -> Column:
        return let(backwards(a), lambda x: let(backwards(b), lambda y: total_length(paragraphs_of(b)) - common(x, y)))

    return let(a_sections, lambda a: let(b_sections, lambda b: let(common(a, b), lambda start: F.struct(start.alias("start"), F.greatest(start, ends(a, b)).alias("end")))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, fingerprint. A null text is empty; repeated rows and equal texts have equal fingerprints; an empty text has a root and no nodes."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("sections", section_strings(F.col("text"))).select("doc_id", "text", fingerprint(F.col("sections")).alias("fingerprint"))


def numbers(values: list[int]) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def with_next(rows: DataFrame, id_col: str, carried: list[str]) -> DataFrame:
    """rows with `following`, a struct of the carried columns of the next row by descending id; the last row's is the first's.

    No task sees all rows: ids go to up to RANGES ranges of about equal count, by quantiles, and beyond RANGES * ROWS_IN_BUCKET rows to even steps within these; each
    bucket also gets the first row of the bucket below. An id that fills ranges of its own, the null one say, is split by the hash of the first carried column. Null
    ids come last; rows of one id are ordered by that hash. A single row follows itself.
    """
    least = -(1 << 63)
    own = [c for c in rows.columns if c != "following"]
    packed = rows.select(F.struct(*own).alias("row"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(least)).alias("key"), F.xxhash64(carried[0]).alias("half"))
    ids = packed.select("key", "half")
    n = ids.count()
    ranges = max(1, min(RANGES, n // ROWS_IN_BUCKET))
    quantiles = ids.agg(F.percentile_approx("key", [i / ranges for i in range(ranges)], 10 * RANGES)).first()[0] or [0]
    bounds = sorted(set(quantiles))
    times = Counter(quantiles)
    shares = [times[b] if times[b] > 2 else 1 for b in bounds]  # parts of an id that is several quantiles at once
    steps, most = max(1, n // len(bounds) // ROWS_IN_BUCKET) if n > RANGES * ROWS_IN_BUCKET else 1, max(shares)
    coarse_bounds = numbers(bounds[::FINE])
    coarse = F.greatest(F.size(F.filter(coarse_bounds, lambda b: b <= F.col("key"))) - 1, F.lit(0))
    fine_bounds = F.slice(numbers(bounds), F.col("coarse") * FINE + 1, F.lit(FINE))
    at = F.greatest(F.col("coarse") * FINE + F.size(F.filter(fine_bounds, lambda b: b <= F.col("key"))) - 1, F.lit(0))
    begin, end = F.get(numbers(bounds), F.col("at")).cast("double"), F.get(numbers(bounds), F.col("at") + 1).cast("double")
    # ids beyond the last bound share its last step
    step = F.least(F.floor((F.col("key").cast("double") - begin) / F.greatest(F.coalesce(end, begin + float(1 << 40)) - begin, F.lit(1.0)) * steps), F.lit(steps - 1))
    share = F.when(F.col("key") == F.get(numbers(bounds), F.col("at")), F.get(numbers(shares), F.col("at"))).otherwise(1)
    # the parts of one id stand in front of the other ids of its range
    part = F.least(F.floor((F.col("half").cast("double") / 2.0**64 + 0.5) * share), share - 1)
    part = F.when(F.col("key") == F.get(numbers(bounds), F.col("at")), part).otherwise(most)

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("coarse", coarse).withColumn("at", at).withColumn("bucket", ((F.col("at") * steps + step) * (most + 1) + part).cast("bigint")).drop("coarse", "at")

    tops = placed(ids).groupBy("bucket").agg(F.max(F.struct("key", "half")).alias("top"))  # one row a bucket
    order, everything = Window.orderBy("bucket"), Window.partitionBy()
    tops = tops.withColumn("above", F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(everything)))
    tops = F.broadcast(tops) if len(bounds) * steps * (most + 1) <= 100_000 else tops
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("lent"))
    there = F.struct(F.col("above").alias("bucket"), F.lit(True).alias("lent"))
    dealt = placed(packed).join(tops, "bucket")
    is_top = (F.col("key") == F.col("top.key")) & (F.col("half") == F.col("top.half"))
    dealt = dealt.withColumn("to", F.explode(F.when(is_top, F.array(here, there)).otherwise(F.array(here))))
    by_id = Window.partitionBy("to.bucket").orderBy(F.col("to.lent"), F.col("key").desc(), F.col("half").desc())
    following = F.lead(F.struct(*[F.col(f"row.{c}") for c in carried])).over(by_id)
    return dealt.withColumn("following", following).where(~F.col("to.lent")).select("row.*", "following")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts alone are shuffled: the next document's fingerprint is made again where it is needed, which costs less than carrying it.

    edit_start and edit_end: the characters of the edited text that its tree differs in from the text's.
    """
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", ["text"]).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("following.text", F.lit(1), half))
    rows = rows.select("doc_id", "n_chars", "text", edited.alias("edited"), F.col("following.text").alias("next"))
    rows = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), *[section_strings(F.col(c)).alias(c) for c in ("text", "edited", "next")])
    rows = rows.select("doc_id", "n_chars", "edited_sha256", *[fingerprint(F.col(c)).alias(f"{c}_print") for c in ("text", "edited", "next")])
    rows = rows.withColumns({f"{c}_sections": sections_of(F.col(f"{c}_print")) for c in ("text", "edited", "next")})
    rows = rows.withColumns({f"{c}_told": told_apart(paragraphs_of(F.col(f"{c}_sections"))) for c in ("text", "edited", "next")})
    near = lambda c: likeness(F.col("text_print"), F.col(f"{c}_print"), F.col("text_told"), F.col(f"{c}_told"))
    rows = rows.withColumn("edit", edit(F.col("text_sections"), F.col("edited_sections")))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", F.col("text_print").alias("fingerprint"), F.col("edited_print").alias("edited_fingerprint"), near("edited").alias("near_edited"), near("next").alias("near_next"),
        F.col("edit.start").alias("edit_start"), F.col("edit.end").alias("edit_end"),
    )
