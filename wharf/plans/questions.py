"""Question bank: validated append and exact random draws (PL-16, SNK-12, DQ-9 … DQ-12).

The bank is any table with a subject column and a use column (the reference's
question records). Drawing ``n`` questions checks the request first — ``n``
from the allowed sizes (DQ-10), every requested subject and the use present
in the bank (DQ-9, an anti join against the bank's distinct values) — then
filters (FLT-9), draws exactly ``n`` rows without replacement (SMP-1) and
shows NULLs as empty strings (FN-12).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from wharf import schemas
from wharf.functions import exprs as X
from wharf.operators.projections import in_list_and_equal
from wharf.operators.quality import require_values
from wharf.operators.sampling import check_allowed, sample_exact
from wharf.sinks.writers import append_record

# The numbers of questions a request may ask for.
ALLOWED_SIZES = (5, 10, 20)


def get_questions(bank: DataFrame, use: str, subjects: Sequence[str], n: int,
                  subject_col: str = "subject", use_col: str = "use",
                  allowed: Sequence[int] = ALLOWED_SIZES, seed: int | None = None) -> DataFrame:
    """``n`` random questions of ``use`` among ``subjects``; raises on a bad request."""
    check_allowed(n, allowed)
    require_values(bank, subject_col, list(subjects))
    require_values(bank, use_col, [use])
    pool = bank.filter(in_list_and_equal(subject_col, list(subjects), use_col, use))
    picked = sample_exact(pool, n, seed=seed)
    return picked.select(*[X.null_to_empty(c).alias(c) for c in picked.columns])


def post_question(bank: DataFrame, record: Mapping[str, object]) -> DataFrame:
    """The bank with one more question; a list of subjects becomes one row each (T-16)."""
    return append_record(bank, record, schemas.QUESTION, explode_lists=["subject"])
