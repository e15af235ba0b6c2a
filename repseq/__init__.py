"""repseq: a PySpark-native engine for immune-receptor amplicon reads."""
