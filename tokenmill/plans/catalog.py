"""Imports every plan module so their queries register themselves."""

from tokenmill.plans import pretrain  # noqa: F401
from tokenmill.plans import corpus  # noqa: F401
from tokenmill.plans import sft  # noqa: F401
from tokenmill.plans import preference  # noqa: F401
from tokenmill.plans import ngram  # noqa: F401
from tokenmill.plans import sampling  # noqa: F401
from tokenmill.plans import runlog  # noqa: F401
from tokenmill.plans import ranking  # noqa: F401
from tokenmill.plans import streams  # noqa: F401
from tokenmill.plans import flows  # noqa: F401
from tokenmill.plans import io  # noqa: F401
