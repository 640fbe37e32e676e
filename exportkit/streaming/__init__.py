from .export import StreamExport

__all__ = ["StreamExport"]
