"""Training-data operators: filters, classifiers, dedup, decontamination, packing and sharding."""
