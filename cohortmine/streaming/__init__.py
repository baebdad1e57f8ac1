"""Structured Streaming over arriving files: the label profile (H1) and frequent itemsets (H4)."""

from cohortmine.streaming.itemset_stream import start_itemsets
from cohortmine.streaming.label_stream import label_counts_stream, start_label_counts

__all__ = ["label_counts_stream", "start_itemsets", "start_label_counts"]
