"""chainflow: chain-activity analytics as Spark DataFrame / SQL / Streaming jobs."""
