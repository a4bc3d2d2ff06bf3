"""All suite modules in reading order; importing them fills the registry."""

from suite import rules  # noqa: F401
from suite import merging  # noqa: F401
from suite import reading  # noqa: F401
from suite import normalizing  # noqa: F401
from suite import observing  # noqa: F401
from suite import jobs  # noqa: F401
from suite import consistency  # noqa: F401
from suite import resuming  # noqa: F401
from suite.common import ORACLES, QUERIES  # noqa: F401
