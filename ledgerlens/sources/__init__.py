from .tables import TableSource
from .fixtures import Fixtures

__all__ = ["TableSource", "Fixtures"]
