"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from promoscope.functions.predicates import (
    action_in, action_not_in, day_window, known_age_lenient, known_age_strict,
    known_gender, young,
)
from promoscope.functions.text import (
    field, join_fields, percent_text, ranked_line, safe_ratio,
)

__all__ = [
    "action_in", "action_not_in", "day_window", "known_age_lenient",
    "known_age_strict", "known_gender", "young", "field", "join_fields",
    "percent_text", "ranked_line", "safe_ratio",
]
