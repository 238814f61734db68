"""Errors of an ingestion. All are ``ValueError`` so that callers can catch one type."""


class IngestionError(ValueError):
    """A dataset cannot be ingested as its control row asks."""


class ControlError(IngestionError):
    """The control table lacks a column, a dataset or a route."""


class SourceError(IngestionError):
    """The source cannot be read, or has no rows."""


class ContractError(IngestionError):
    """The source's columns differ from the declared ones."""


class TransformError(IngestionError):
    """The control row's SQL was refused by Spark."""


class SinkError(IngestionError):
    """The write mode or the target does not fit."""


class MergeError(SinkError):
    """An upsert has no usable keys, target or source rows."""
