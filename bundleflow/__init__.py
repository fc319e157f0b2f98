"""bundleflow: moving file bundles from an untrusted drop area to trusted
storage as Spark DataFrame work.

The main entry points, by area:

* columns: :mod:`bundleflow.functions.paths`, :mod:`bundleflow.functions.records`
* sources and sinks: :mod:`bundleflow.sources`
* operators: :mod:`bundleflow.operators` (content, matching, aggregates,
  ordering, decisions)
* whole flows: :mod:`bundleflow.plans.vm_ingest`, :mod:`bundleflow.plans.host_promote`
* streams: :mod:`bundleflow.streaming.watchers`
"""

from bundleflow.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
