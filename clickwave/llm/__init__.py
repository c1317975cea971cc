"""Training-data operators: counting, deduplicating, cleaning, mixing and
packing text corpora.  Nothing else in the library imports this subpackage."""
