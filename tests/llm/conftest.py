from .cases import rng  # noqa: F401
