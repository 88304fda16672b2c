"""Column expressions. Every function takes and returns a Column, so all of it stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom import fixed


def blank_to_null(col: Column) -> Column:
    return F.when(col.rlike(r"(?U)^\s*$"), None).otherwise(col)


def csv_null(col: Column) -> Column:
    """Null for every token that a CSV reader takes for a missing value."""
    return F.when(col.isin(fixed.CSV_NULL_TOKENS), None).otherwise(col)


def to_number(col: Column, default: float | None = None) -> Column:
    number = col.try_cast("double")
    return number if default is None else F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(default))


def clean_description(col: Column) -> Column:
    text = F.lower(F.coalesce(col, F.lit("")))
    text = F.regexp_replace(text, r"(?U)#\d+", " ")
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def merchant_name(col: Column) -> Column:
    return F.lower(F.trim(F.coalesce(col, F.lit(""))))


def amount_bucket(raw: Column) -> Column:
    """Size class of \\|amount\\|; missing values fall into the open class, unreadable text has its own."""
    number = raw.try_cast("double")
    bucket = F.when(raw.isNotNull() & number.isNull(), fixed.AMOUNT_BUCKET_BAD)
    for bound, name in fixed.AMOUNT_BUCKETS:
        bucket = bucket.when(F.abs(number) < bound, name)
    return bucket.otherwise(fixed.AMOUNT_BUCKET_TOP)


def hash_order(row_id: Column, seed: Column | int) -> Column:
    """Text whose sort order is a fixed pseudo-random order of the rows."""
    return F.md5(F.concat_ws(":", row_id.cast("string"), (F.lit(seed) if isinstance(seed, int) else seed).cast("string")))


def hash_prefix(hashed: Column, digits: int) -> Column:
    """The leading hex digits as a number, evenly spread over 16**digits values."""
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("long")


def base_score(prob: Column, flag: Column | None = None) -> Column:
    doubt = F.lit(1.0) - prob
    return doubt if flag is None else doubt + F.coalesce(flag.cast("double"), F.lit(0.0))


def rank_score(prob: Column, wrong: Column) -> Column:
    return (F.lit(1.0) - prob) + F.lit(0.25) * wrong.cast("double")


def suspicion(prob: Column, wrong: Column, rank: Column | None = None) -> Column:
    """Review score; with ``rank`` the published form in which the probability cancels out."""
    score = (F.lit(1.0) - prob) + wrong.cast("double")
    return score if rank is None else score + (F.lit(1.0) - rank)


def flag_suspicious(label: Column, predicted: Column, prob: Column, threshold: float = fixed.SUSPICIOUS_PROB) -> Column:
    return (predicted != label) & (prob < threshold)


def focal_weight(prob: Column, scale: float = 0.75, gamma: float = 2.0, low: float = 0.05, high: float = 2.5) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), F.lit(scale) * F.pow(F.lit(1.0) - prob, F.lit(gamma))))


def minority_focal_weight(prob: Column, is_minority: Column) -> Column:
    raised = F.when(is_minority, F.lit(1.0) + F.lit(1.2) * F.pow(F.lit(1.0) - prob, F.lit(2.0))).otherwise(F.lit(1.0))
    return F.greatest(F.lit(0.5), F.least(F.lit(3.0), raised))


def keyword_correction(description: Column, label: Column, predicted: Column, rules, word: bool = False) -> tuple[Column, Column]:
    """(corrected label, note) by the first rule whose keyword occurs; the model has to agree."""
    text = F.lower(F.trim(F.coalesce(description, F.lit(""))))
    target = F.lit(None).cast("string")
    keyword = F.lit(None).cast("string")
    for word_text, word_label in reversed(list(rules)):
        hit = text.rlike(r"(?U)\b\Q" + word_text + r"\E\b") if word else text.contains(word_text)
        target = F.when(hit, F.lit(word_label)).otherwise(target)
        keyword = F.when(hit, F.lit(word_text)).otherwise(keyword)
    change = F.coalesce((target != label) & (predicted == target), F.lit(False))
    corrected = F.when(change, target).otherwise(label)
    note = F.when(change, F.concat(F.lit("keyword='"), keyword, F.lit("' + model_agrees"))).otherwise(F.lit(""))
    return corrected, note
