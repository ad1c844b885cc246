from payscore.functions.buckets import bucketize
from payscore.functions.identity import date_parts, id_age, id_region, id_sex
from payscore.functions.numbers import (
    argmax,
    chunks,
    confidence,
    constant,
    let,
    percent_text,
    softmax,
    softmax_shares,
    sum_arrays,
    total,
    votes,
)
from payscore.functions.values import category_value, label_column, split_bucket

__all__ = [
    "argmax", "bucketize", "category_value", "chunks", "confidence", "constant", "date_parts",
    "id_age", "id_region", "id_sex", "label_column", "let", "percent_text", "softmax",
    "softmax_shares", "split_bucket", "sum_arrays", "total", "votes",
]
