"""Spark ML pipelines: text (M1–M5, M11), tabular (M6–M9, M12) and the
model operators (M10, M13–M17)."""
