"""Typed errors, one per kind of wrong argument."""

from __future__ import annotations


class TripmillError(Exception):
    """Base of every error this package raises on purpose."""


class MissingKeysError(TripmillError):
    """A de-duplication was asked for without key columns."""


class MissingOrderError(TripmillError):
    """A de-duplication was asked for without order columns."""


class PartitionColumnError(TripmillError):
    """A partition column is missing, unknown, or not a small set of values."""


class MergeKeysError(TripmillError):
    """An upsert has no key columns, or keys the tables do not have."""


class MergeError(TripmillError):
    """An upsert cannot run: bad target, columns or change condition."""


class DuplicateSourceKeyError(MergeError):
    """Several source rows would change the same target row."""


class TableMismatchError(TripmillError, ValueError):
    """A table that exists has other types or partition columns than the one asked for."""
