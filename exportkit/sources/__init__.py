from .frame import FrameSource
from .jdbc import JdbcSource
from .sql import SqlSource, scalar

__all__ = ["FrameSource", "JdbcSource", "SqlSource", "scalar"]
