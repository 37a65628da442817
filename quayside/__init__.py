"""quayside — dated JSON deliveries to history and current-state tables on Spark.

Everything is plain DataFrame / SQL work on ordinary Spark tables:

* ``sources``   – landing-folder discovery and the enveloped multiline JSON scan
* ``functions`` – column builders (JSON text, nested re-shaping, contract casts, dates)
* ``operators`` – DataFrame -> DataFrame steps (flatten, lineage, conform, latest, upsert, profile)
* ``sinks``     – history table writes, the bucketed current-state table, views
* ``plans``     – the run shapes (history ingest, current-state build) and contracts
* ``streaming`` – file-arrival driven history ingest with Structured Streaming
"""

from quayside.errors import ContractError, NoNewData, Outcome, RunResult

__all__ = ["ContractError", "NoNewData", "Outcome", "RunResult"]
