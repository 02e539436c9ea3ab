from . import adapters, dims, io, tables  # noqa: F401
