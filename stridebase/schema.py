"""Column names and types of the raw race results."""

from pyspark.sql import types as T

# Fixed values: (header in the raw file, column name, type). Text columns are read as
# strings on purpose: inference turns an all-clean "4:51:39" column into timestamps.
RAW_COLUMNS = [
    ("Year of event", "year_of_event", T.IntegerType()),
    ("Event dates", "event_dates", T.StringType()),
    ("Event name", "event_name", T.StringType()),
    ("Event distance/length", "event_distance_length", T.StringType()),
    ("Event number of finishers", "event_number_of_finishers", T.IntegerType()),
    ("Athlete performance", "athlete_performance", T.StringType()),
    ("Athlete club", "athlete_club", T.StringType()),
    ("Athlete country", "athlete_country", T.StringType()),
    ("Athlete year of birth", "athlete_year_of_birth", T.DoubleType()),
    ("Athlete gender", "athlete_gender", T.StringType()),
    ("Athlete age category", "athlete_age_category", T.StringType()),
    ("Athlete average speed", "athlete_average_speed", T.StringType()),
    ("Athlete ID", "athlete_id", T.LongType()),
]

RAW_TO_BRONZE = {header: name for header, name, _ in RAW_COLUMNS}
BRONZE_TO_RAW = {name: header for header, name, _ in RAW_COLUMNS}
BRONZE_COLUMNS = [name for _, name, _ in RAW_COLUMNS]

RAW_SCHEMA = T.StructType([T.StructField(header, kind) for header, _, kind in RAW_COLUMNS])
BRONZE_SCHEMA = T.StructType([T.StructField(name, kind) for _, name, kind in RAW_COLUMNS])
