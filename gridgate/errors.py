"""Exceptions raised on the driver."""

from __future__ import annotations


class IntakeError(Exception):
    """Base class of everything this package raises."""


class ConfigurationError(IntakeError, ValueError):
    """The run description contradicts itself or misses a part."""


class UnsupportedTypeError(IntakeError, ValueError):
    """A declared type has no rule in the chosen dialect."""


class SourceError(IntakeError):
    """A source cannot be read: missing, empty, unknown sheet or table."""


class HeaderError(IntakeError):
    """A header row breaks the naming rules."""


class TemplateError(IntakeError):
    """A template workbook is not well formed."""


class DataValidationError(IntakeError):
    """Rows broke the contract and the error mode asks to stop.

    ``outcome`` carries the frames of the run (violations, verdicts, metrics).
    """

    def __init__(self, message: str, outcome=None):
        super().__init__(message)
        self.outcome = outcome
