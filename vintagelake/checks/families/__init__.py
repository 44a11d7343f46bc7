"""Query families; importing the package registers all of them."""

from vintagelake.checks.families import asof  # noqa: F401
from vintagelake.checks.families import identity  # noqa: F401
from vintagelake.checks.families import adjust  # noqa: F401
from vintagelake.checks.families import features  # noqa: F401
from vintagelake.checks.families import quality  # noqa: F401
from vintagelake.checks.families import fundamentals  # noqa: F401
from vintagelake.checks.families import macro  # noqa: F401
from vintagelake.checks.families import universe  # noqa: F401
from vintagelake.checks.families import health  # noqa: F401
from vintagelake.checks.families import surface  # noqa: F401
from vintagelake.checks.families import capture  # noqa: F401
