"""corpusmill: a Spark-native engine for building and analysing text corpora."""
