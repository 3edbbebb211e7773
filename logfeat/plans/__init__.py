"""The three batch jobs, composed from the operators."""

from .features import feature_matrix, feature_table, gap_matrix, token_matrices  # noqa: F401
from .prepare import prepare, with_folds  # noqa: F401
from .score import score  # noqa: F401
