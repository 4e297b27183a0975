"""Document fingerprints by consistent weighted sampling, in built-in expressions only.

A text is a bag of terms: pairs of neighbouring words, weighted by how often they come (of a single word, the word). Every
term draws for each of ``SAMPLES`` samples two gamma(2, 1) variables r and c and a uniform b from hashes of itself. With
weight s, t = floor(ln(s) / r + b), and ln(a) = ln(c) - r * (t - b) - r. A sample is the pair (term, t) with the smallest a:
two texts get the same with a probability of the sum of their terms' smaller weights over the sum of the larger ones. The
share of equal samples has a standard error of at most 1 / (2 * sqrt(SAMPLES)), that is 0.0625, and is off by 0.2 or more
in at most 1.2 % of pairs (Hoeffding: 2 * exp(-2 * SAMPLES * 0.2**2)), over the draw of hashes.

A sample is one number, ln(a) before and a hash of (term, t) after the point, so that all samples are plain minima over
a text's exploded terms. A term is exploded once more into groups of ``GROUP`` samples, so that an aggregate has few of
them and its generated code is short. Terms are counted inside their row, by sorting them, so no table of terms is built.

The smallest a of a text with weights of sum W is exponential with mean 1 / W. So a sample is drawn in full only if it may
be below ``LIMIT`` / W, as told without logarithms: c >= 1 - u2 * u3, and exp(-r * (t - b) - r) >= u0 * u1 / s. A text whose
smallest a is not below that (exp(-``LIMIT``) of them for each sample) is drawn anew without a limit, so results don't depend
on it. Documents stay where the order of doc_ids has put them, and
the texts are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.tables import written
from trackloom.llm.words import key_of

SAMPLES = 64
#: Samples that are drawn side by side in one row; divides SAMPLES.
GROUP = 4
#: A text's samples are sought below this, over the sum of its weights; far above any a without such a limit.
LIMIT, NO_LIMIT = 24.0, 1e300
#: Consecutive doc_ids that stand together, and such buckets that stand together in turn.
BUCKET = 256
#: Bits of a sample that tell it apart; hexadecimal digits of it in a fingerprint.
ID_BITS, DIGITS = 22, 5
SPACE = r"[\x20\x09-\x0D]+"


def _uniform(h: Column, part: int) -> Column:
    """One of five numbers between 0 and 1, of 12 bits each, in a 64-bit hash."""
    return (F.shiftrightunsigned(h, 12 * part).bitwiseAND(F.lit((1 << 12) - 1)) + F.lit(0.5)) * F.lit(1.0 / (1 << 12))


def _order(log_a: Column) -> Column:
    """13 bits before and 27 after the point."""
    return ((log_a + F.lit(4096.0)) * F.lit(float(1 << 27))).cast("long")


def sample(term: Column, log_weight: Column, j: Column) -> Column:
    """The j-th sample of a term (j: an int column): smaller wins."""
    h = F.xxhash64(term, j)
    r = -F.ln(_uniform(h, 0) * _uniform(h, 1))
    log_c = F.ln(-F.ln(_uniform(h, 2) * _uniform(h, 3)))
    b = _uniform(h, 4)
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t - b) - r
    # the order, then the mark of (term, t)
    return F.shiftleft(_order(log_a), ID_BITS).bitwiseOR(h.bitwiseXOR(t).bitwiseAND(F.lit((1 << ID_BITS) - 1)))


def may_win(term: Column, weight: Column, j: Column, limit: Column) -> Column:
    """False only if the a of the j-th sample of a term is limit or more.

    With weight 1, t is 0 and a = c * x**(1 - b) for x = u0 * u1, where x**(1 - b) >= x / (1 - b * (1 - x)) (Bernoulli).
    """
    h = F.xxhash64(term, j)
    x = _uniform(h, 0) * _uniform(h, 1)
    b = F.when(weight == 1, 1.0).otherwise(0.0) * _uniform(h, 4)
    return (F.lit(1.0) - _uniform(h, 2) * _uniform(h, 3)) * x < limit * weight * (F.lit(1.0) - b * (F.lit(1.0) - x))


def terms(text: Column) -> Column:
    """Hashes of the pairs of neighbouring words; of a single word, its own."""
    return F.transform(F.array(text), _terms_of)[0]


def _terms_of(text: Column) -> Column:
    words = F.array_remove(F.split(text, SPACE), "")
    return F.transform(F.array(words), lambda w: F.when(F.size(w) == 1, F.array(F.xxhash64(w[0]))).otherwise(
        F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))))[0]


def counted(rows: DataFrame) -> DataFrame:
    """rows with ``__counts``, the different values of the sorted array ``__terms`` with how often each comes.

    Steps are columns of their own, so that no lambda works an array out anew for every element.
    """
    n = F.size("__terms")
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice("__terms", F.lit(1), F.greatest(n - 1, F.lit(0))))
    new = F.zip_with(F.col("__terms"), F.slice(before, F.lit(1), F.greatest(n, F.lit(0))), lambda a, b: F.when(~a.eqNullSafe(b), a))
    rows = rows.withColumn("__starts", F.filter(F.transform(new, lambda x, i: F.struct(x.alias("term"), i.alias("i"))), lambda e: e.term.isNotNull()))
    m = F.size("__starts")
    ends = F.concat(F.transform(F.slice("__starts", F.lit(2), F.greatest(m - 1, F.lit(0))), lambda e: e.i), F.slice(F.array(n), F.lit(1), F.least(m, F.lit(1))))
    return rows.withColumn("__counts", F.zip_with("__starts", ends, lambda e, end: F.struct(e.term.alias("term"), (end - e.i).alias("s"))))


def bags(texts: DataFrame, keys: list[str], limit: float = LIMIT) -> DataFrame:
    """keys, ``limit``, and the terms of column ``text`` (``term``, ``weight``, ``log_s``), once for each ``group`` of samples."""
    bag = counted(texts.select(*keys, F.sort_array(terms(F.col("text"))).alias("__terms")))
    bag = bag.withColumn("limit", F.lit(limit) / F.greatest(F.size("__terms"), F.lit(1)))
    # an inner explode would be given a filter that works the counts out once more, in every lambda that reads them
    bag = bag.select(*keys, "limit", F.explode_outer("__counts").alias("e")).where("e is not null")
    bag = bag.select(*keys, "limit", F.col("e.term").alias("term"), F.col("e.s").cast("double").alias("weight"), F.ln("e.s").alias("log_s"))
    return bag.select(*keys, "limit", "term", "weight", "log_s", F.explode(F.lit(list(range(SAMPLES // GROUP)))).alias("group"))


def drawn(j: int) -> Column:
    """The j-th sample of a row of ``bags``, null if it can't be below the limit."""
    n = F.col("group") * GROUP + j
    return F.when(may_win(F.col("term"), F.col("weight"), n, F.col("limit")), sample(F.col("term"), F.col("log_s"), n))


def signatures(texts: DataFrame, keys: list[str], limit: float = NO_LIMIT) -> DataFrame:
    """keys and ``ids``, an array of SAMPLES marks, for column ``text``; rows without words are left out.

    keys: they tell the rows apart. If texts is dealt out by some of them, nothing is shuffled. limit: where the smallest a is
    not below limit over the number of terms, ids has a null; NO_LIMIT leaves none.
    """
    least = bags(texts, keys, limit).groupBy(*keys, "group").agg(F.max("limit").alias("limit"), *[F.min(drawn(j)).alias(f"s{j}") for j in range(GROUP)])
    # one step of the order less, for what rounding does
    top = F.shiftleft(_order(F.ln("limit")) - F.lit(1), ID_BITS)
    marks = [F.when(F.col(f"s{j}") < top, F.col(f"s{j}").bitwiseAND(F.lit((1 << min(ID_BITS, 4 * DIGITS)) - 1))) for j in range(GROUP)]
    groups = least.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("group", F.array(*marks).alias("marks")))).alias("groups"))
    return groups.select(*keys, F.flatten("groups.marks").alias("ids"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples; texts without words are like each other and nothing else."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(SAMPLES))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(same)


def fingerprint(ids: Column) -> Column:
    """The samples in hexadecimal, end to end; empty for a text without words."""
    return F.coalesce(F.array_join(F.transform(ids, lambda x: F.lpad(F.lower(F.hex(x)), DIGITS, "0")), ""), F.lit(""))


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), ``bucket`` and ``key``: buckets follow each other in the order of doc_ids, nulls first."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key_of().alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("bucket", F.shiftright("key", BUCKET.bit_length() - 1))


def _following(buckets: DataFrame) -> DataFrame:
    """bucket and ``after``, the next bucket with rows; after the last comes the first."""
    b = buckets.select("bucket").distinct().withColumn("upper", F.shiftright("bucket", BUCKET.bit_length() - 1))
    tops = b.groupBy("upper").agg(F.min("bucket").alias("least"))
    # one row per BUCKET * BUCKET doc_ids
    w = Window.orderBy("upper")
    tops = tops.select("upper", F.coalesce(F.lead("least").over(w), F.first("least").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("jump"))
    own = b.withColumn("near", F.lead("bucket").over(Window.partitionBy("upper").orderBy("bucket")))
    return own.join(tops, "upper").select("bucket", F.coalesce("near", "jump").alias("after"))


def with_next(rows: DataFrame, value: str, order: list[str]) -> DataFrame:
    """rows with ``rank`` (in its bucket) and ``next``, what the next row has in column ``value``; the last row's next is the first.

    value: a column without nulls.
    """
    w = Window.partitionBy("bucket").orderBy(*order)
    ranked = rows.withColumns({"rank": F.row_number().over(w), "next": F.lead(value).over(w)})
    heads = ranked.where("rank = 1").select(F.col("bucket").alias("after"), F.col(value).alias("jump"))
    jumps = _following(rows).join(heads, "after").select("bucket", "jump")
    return ranked.join(jumps, "bucket").withColumn("next", F.coalesce("next", "jump")).drop("jump")


def _marks(rows: DataFrame, limit: float) -> DataFrame:
    """bucket, rank, and the samples of columns text (``ids``) and edited (``edited_ids``), null without words."""
    # doc_id goes along so that all readers of the rows share one exchange
    both = rows.select("bucket", "rank", "doc_id", F.explode(F.array(F.struct(F.lit(0).alias("edition"), F.col("text").alias("text")), F.struct(F.lit(1).alias("edition"), F.col("edited").alias("text")))).alias("e"))
    marks = signatures(both.select("bucket", "rank", "doc_id", "e.edition", "e.text"), ["bucket", "rank", "doc_id", "edition"], limit)
    return marks.groupBy("bucket", "rank").agg(F.max(F.when(F.col("edition") == 0, F.col("ids"))).alias("ids"), F.max(F.when(F.col("edition") == 1, F.col("ids"))).alias("edited_ids"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next, one row per input row.

    A null text is empty. Texts without words have the empty fingerprint and likeness 1 among themselves, 0 to others. Rows
    with equal doc_ids follow each other in the order of their texts, null doc_ids come first. A document alone is its own
    next. Other columns, whatever their names, are left out.
    """
    rows = with_next(in_order(docs), "text", ["key", "text"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("bucket", "rank", "doc_id", "text", n.cast("long").alias("n_chars"), F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next"), F.lit(1), half)).alias("edited"))
    facts = rows.select("bucket", "rank", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    none = F.array().cast("array<bigint>")
    signed = facts.join(_marks(rows, LIMIT), ["bucket", "rank"], "left").withColumns({"ids": F.coalesce("ids", none), "edited_ids": F.coalesce("edited_ids", none)})
    signed = written(signed, "fingerprints")
    lacking = signed.where(F.exists("ids", F.isnull) | F.exists("edited_ids", F.isnull)).select("bucket", "rank")
    if not lacking.isEmpty():
        again = _marks(rows.join(lacking, ["bucket", "rank"], "left_semi"), NO_LIMIT).withColumnsRenamed({"ids": "all_ids", "edited_ids": "all_edited_ids"})
        signed = signed.join(again, ["bucket", "rank"], "left").withColumns({"ids": F.coalesce("all_ids", "ids"), "edited_ids": F.coalesce("all_edited_ids", "edited_ids")}).drop("all_ids", "all_edited_ids")
    out = with_next(signed.withColumnRenamed("rank", "place"), "ids", ["place"])
    return out.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("ids")).alias("fingerprint"), fingerprint(F.col("edited_ids")).alias("edited_fingerprint"),
                      likeness(F.col("ids"), F.col("edited_ids")).alias("near_edited"), likeness(F.col("ids"), F.col("next")).alias("near_next"))
