"""Column-level helpers: exact money, calendar parts, change hashes."""

from starloom.functions import dates, hashing, money  # noqa: F401
