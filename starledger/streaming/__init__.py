from starledger.streaming.increments import ingest_new_files  # noqa: F401
