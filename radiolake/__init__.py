"""Raw radio-mesh messages to a packet history and a node directory, on Spark."""
