from tickspark.functions.market import *  # noqa: F401,F403
from tickspark.functions.time import *  # noqa: F401,F403
