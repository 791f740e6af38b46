"""tidegauge: a Spark-first analytics engine for daily series, with a corpus toolkit beside it."""
