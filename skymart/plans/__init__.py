from skymart.plans import enriched, marts, pipeline, reports, staging

__all__ = ["enriched", "marts", "pipeline", "reports", "staging"]
