"""Fixed values. Results depend on them; every one is the default of a parameter."""

# Zone of local dates and times.
LOCAL_ZONE = "America/New_York"

# Idle time: longest gap that counts, value of a repeated report, direction, stations left out.
IDLE_MAX_GAP_S = 300
IDLE_REPEAT_S = 60
IDLE_DIRECTION = "Southbound"
IDLE_EXCLUDED = ("Broad Channel",)

# Headway: longest gap that counts, in whole minutes.
HEADWAY_MAX_MINUTES = 20

# Busiest stations: length of the list.
BUSIEST_TOP = 10

# Training data: line and direction, target stop, stops of context, shares of the days.
SAMPLE_ROUTE = "E"
SAMPLE_DIRECTION = "S"
SAMPLE_TARGET_STOP = "Lexington Av/53 St"
SAMPLE_CONTEXT_STOPS = 5
SPLIT_TRAIN_SHARE = 0.70
SPLIT_VALIDATION_SHARE = 0.85

# Numeric features of a context stop in matrix order: column suffix and attribute.
FEATURES = {
    "hour": "hour_of_day",
    "day": "day_of_week",
    "rush": "is_rush_hour",
    "weekend": "is_weekend",
    "minutes": "minutes_since_prev_stop",
    "lat": "stop_lat",
    "lon": "stop_lon",
    "seq": "stop_sequence",
}

# Lines of the split summary; names in braces stand for values.
SPLIT_SUMMARY = (
    "═" * 51,
    "DATA SPLIT SUMMARY",
    "═" * 51,
    "",
    "Full date range: {min_date} to {max_date}",
    "Total days: {total_days}",
    "",
    "TRAIN:      {min_date} to {train_end_date}",
    "VALIDATION: {val_start_date} to {val_end_date}",
    "TEST:       {test_start_date} to {max_date}",
    "",
    "--- Sample Counts ---",
    "Train samples: {train}",
    "Val samples: {val}",
    "Test samples: {test}",
    "═" * 51,
)

# Streaming: window length, lateness, shortest time between two batches.
STREAM_WINDOW = "30 seconds"
STREAM_LATENESS = "10 seconds"
STREAM_EVERY = "5 seconds"

# De-duplication: time for which a report is remembered, parts that repeats are split into.
DEDUPE_HORIZON = "10 minutes"
DEDUPE_SPREAD = 8

# Monthly load: bad records a month may have.
MAX_BAD_RECORDS = 1000
