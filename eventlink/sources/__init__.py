"""Reading and writing: schemas, scans, hour folders, sinks."""
