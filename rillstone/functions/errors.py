"""Classes of a document database's errors, by their codes and names.

Fixed values: the codes below are the wire protocol's.
"""

from __future__ import annotations

CODES = {
    "not_found": {26, 27}, "exists": {48}, "options_conflict": {85}, "key_specs_conflict": {86}, "duplicate_key": {11000}, "invalid_options": {72},
    "drop_pending": {215}, "history_lost": {286}, "collection_dropped": {175}, "delta_failed": {28, 29},
    "transient": {6, 7, 89, 91, 189, 262, 9001, 10107, 11600, 11602, 13435, 13436},
}
#: What a late schema change may meet without harm.
BENIGN = ("not_found", "invalid_options", "drop_pending")


def error_class(code: int | None) -> str | None:
    return next((name for name, codes in CODES.items() if code in codes), None)


def is_transient(code: int | None, labels: tuple[str, ...] = ()) -> bool:
    return error_class(code) == "transient" or bool({"RetryableWriteError", "TransientTransactionError", "NetworkError"} & set(labels))


def is_benign(code: int | None) -> bool:
    return error_class(code) in BENIGN


class CommandError(RuntimeError):
    """A command that the database refuses, with its code."""

    def __init__(self, code: int, text: str):
        super().__init__(text)
        self.code = code
