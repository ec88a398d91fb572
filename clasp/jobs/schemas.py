"""Input schemas of the reference applications (all fields nullable)."""

# Column names and types of the labelled text file and of the
# patient record (CSV rows and stream messages).
TEXT_SCHEMA = "texto string, etiqueta string"
ENRICHED_TEXT_SCHEMA = "id bigint, texto string, etiqueta string, fecha timestamp"
RECORD_SCHEMA = ("Age int, Sex string, ChestPainType string, RestingBP int, Cholesterol int, "
                 "FastingBS int, RestingECG string, MaxHR int, ExerciseAngina string, "
                 "Oldpeak double, ST_Slope string, HeartDisease int")
