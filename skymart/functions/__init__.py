from skymart.functions import exact, flights

__all__ = ["exact", "flights"]
