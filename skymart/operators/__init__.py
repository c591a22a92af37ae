from skymart.operators import aggregates, checks, lookups

__all__ = ["aggregates", "checks", "lookups"]
