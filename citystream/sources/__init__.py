"""Sources: TESTDATA adapters, Kafka/file stream sources, lookup and history readers."""
