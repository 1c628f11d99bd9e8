from barsignal.functions.rolling import change, div, nan_to_null, roll  # noqa: F401
from barsignal.functions.scalars import *  # noqa: F401,F403
