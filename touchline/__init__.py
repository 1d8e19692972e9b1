"""touchline: a Spark-native analytics engine for scouting-style event, season and transfer data."""
