"""Token-corpus analytics on Spark: tokenizer training, encoding, corpus
statistics, token datasets, count-based next-token models, vector-table
operators and a table-keyed optimizer, all as DataFrame functions."""
