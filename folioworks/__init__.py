"""Document-page refinement as PySpark DataFrame operations."""

from folioworks.config import EngineConfig

__all__ = ["EngineConfig"]
__version__ = "0.1.0"
