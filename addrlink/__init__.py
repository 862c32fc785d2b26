"""Address analytics on Spark: street registers, map features, spatial linking, inventories, and text corpora."""
