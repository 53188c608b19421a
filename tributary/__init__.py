"""tributary: partition-at-a-time batch ingestion expressed as Spark jobs.

Sub-packages:
  sources    -- named locations, partition reads/writes, file listings, paged
                listings, message files
  operators  -- item tables (walk, resolve, fetch), run log, step graphs,
                quality checks
  functions  -- column expressions, named transforms, guarded/retrying maps,
                salted joins
  plans      -- composed ingestion runs (transport step, failure policy, job
                runs) and the registered queries
  streaming  -- incremental (exactly-once) file ingestion

The most used entry points are re-exported here (imported on first use).
"""

__version__ = "0.1.0"

_EXPORTS = {
    "build_session": "tributary.session",
    "get_source": "tributary.sources.locations",
    "get_sink": "tributary.sources.locations",
    "read_partition": "tributary.sources.locations",
    "write_partition": "tributary.sources.locations",
    "write_partitions": "tributary.sources.locations",
    "register_location_type": "tributary.sources.locations",
    "RunLog": "tributary.operators.runlog",
    "copy_partition": "tributary.plans.ingest",
    "ingest_partitions": "tributary.plans.ingest",
    "run_job": "tributary.plans.jobs",
    "register": "tributary.functions.registry",
}


def __getattr__(name):
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)


__all__ = sorted(_EXPORTS)
