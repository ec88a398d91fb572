from clasp.functions.scalars import (
    round_half_even, round_like_python, pct, safe_ratio_pct, guess_scalar,
    parse_ts, format_ts, format_ts_pystr, map_values_expr,
)
from clasp.functions.hashing import hash_bucket
from clasp.functions.text import tokens_expr, nonempty_tokens_expr, drop_stop_words_expr
from clasp.functions.stopwords import ENGLISH_STOP_WORDS

__all__ = [
    "round_half_even", "round_like_python", "pct", "safe_ratio_pct", "guess_scalar",
    "parse_ts", "format_ts", "format_ts_pystr", "map_values_expr", "hash_bucket", "tokens_expr",
    "nonempty_tokens_expr", "drop_stop_words_expr", "ENGLISH_STOP_WORDS",
]
