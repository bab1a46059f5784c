"""Exceptions of the lake; all are LakeError."""


class LakeError(Exception):
    """Base of all."""


class SchemaNotFoundError(LakeError, LookupError):
    pass


class TableNotFoundError(LakeError, LookupError):
    pass


class ColumnNotFoundError(LakeError, LookupError):
    pass


class ViewNotFoundError(LakeError, LookupError):
    pass


class SnapshotNotFoundError(LakeError, ValueError):
    pass


class AlreadyExistsError(LakeError, ValueError):
    pass


class SchemaMismatchError(LakeError, ValueError):
    pass


class ConstraintError(LakeError, ValueError):
    pass


class MergeError(LakeError, ValueError):
    pass


class ConcurrentModificationError(LakeError):
    """Another commit changed what this one was based on."""
