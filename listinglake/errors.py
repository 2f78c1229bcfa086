"""Errors a caller can act on."""


class ListingLakeError(Exception):
    """Base of all errors raised here."""


class LandingNotFoundError(ListingLakeError):
    """The landing folder is missing or holds no document."""


class UnusableLandingError(ListingLakeError):
    """Documents have landed, but none of them holds a listing array."""


class NothingCollectedError(ListingLakeError):
    """No response of a collection gave a listing."""


class SnapshotLogError(ListingLakeError):
    """A commit log cannot be replayed from its JSON commits alone."""


class ExportError(ListingLakeError):
    """An export did not give the promised files."""


class PublicationConflictError(ListingLakeError):
    """Another writer has published since the state this one was built from."""


class IntegrityError(ListingLakeError):
    """Staged tables do not fit together; they were not published."""
