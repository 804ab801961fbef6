"""Compare rail and bus use within walking distance of each station, on Spark."""
