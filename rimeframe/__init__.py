"""rimeframe: station-day weather analytics written as Spark DataFrame operators."""
