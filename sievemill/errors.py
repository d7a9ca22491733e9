"""What can go wrong in a collection, and whether it is worth another try."""

from __future__ import annotations


class CollectionError(Exception):
    """Any failure of a collection. ``retryable`` says whether a later run may succeed."""

    retryable = False

    def describe(self) -> str:
        """Kind and message in one line, as ledgers keep it."""
        return f"{type(self).__name__}: {self}"


class ParseError(CollectionError, ValueError):
    """A page or a log line that can't be read."""


class RejectedQuery(CollectionError):
    """The source refused a search and said why."""


class SessionExpired(CollectionError):
    """The view a request belonged to is gone; a new one may work."""

    retryable = True


class RateLimited(CollectionError):
    """The source asked to slow down more often than a request may be retried."""

    retryable = True


class BreakerOpen(CollectionError):
    """Too many refusals in a row: the run has to stop."""

    retryable = True


class DownloadFailed(CollectionError):
    """A file that couldn't be fetched or isn't what it should be."""


class RunAborted(CollectionError):
    """A run that ended early, with the summary so far."""

    def __init__(self, message: str, summary: dict) -> None:
        super().__init__(message)
        self.summary = summary
