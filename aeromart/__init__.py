"""Analytics on environmental sensor readings, as PySpark DataFrame operators and jobs."""

from . import fixed
from .functions import *  # noqa: F401,F403
from .functions import __all__ as _functions
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .sources import *  # noqa: F401,F403
from .sources import __all__ as _sources
from .streaming import *  # noqa: F401,F403
from .streaming import __all__ as _streaming
from .plans import *  # noqa: F401,F403
from .plans import __all__ as _plans
from .session import pin_utc, shared_folder

__all__ = [
    "fixed",
    "pin_utc",
    "shared_folder",
    *_functions,
    *_operators,
    *_sources,
    *_streaming,
    *_plans,
]
