"""Where messages and rows come from: files, Kafka topics and the stored tables."""
