from skymart.sources import archives, flight_files, lookup_files, warehouse

__all__ = ["archives", "flight_files", "lookup_files", "warehouse"]
