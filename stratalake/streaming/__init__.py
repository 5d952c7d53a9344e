from .refresh import datasets, manifest_changes, manifest_of, refresh_changed, refresh_years, stream_refresh

__all__ = ["datasets", "manifest_changes", "manifest_of", "refresh_changed", "refresh_years", "stream_refresh"]
