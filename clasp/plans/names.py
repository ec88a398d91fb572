"""Names that several plans show."""

# The dashboard's risk names and its default prediction.
RISK_NAMES = {0: "Sano", 1: "Riesgo"}
MISSING_PREDICTION = "desconocido"
