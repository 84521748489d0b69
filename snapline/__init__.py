"""Play-by-play and player-tracking analytics as composable Spark DataFrame operators."""
