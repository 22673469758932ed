"""Landing files: schemas, rescue, shards, generated data and table writes."""
