"""Parameters, with the defaults of the published workload."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Config:
    #: The account that uploads are paid from; never has a default.
    account: str
    cutover: date = date(2025, 11, 26)
    earliest_file: date = date(2025, 4, 1)
    earliest_ledger: date = date(2025, 4, 1)
    year: int = 2025
    fuzzy_threshold: int = 85
    token_ratio: float = 0.60
    token_overlap: int = 2
    amount_tolerance: float = 0.05
    name_limit: int = 50
    root: str = "."
    #: Codes of one's own bank, which are never the sender of an outgoing message.
    own_codes: tuple[str, ...] = ()
    #: `module:factory` of what reads the files of messages.
    recogniser: str = "ledgerloom.sources.pages:plain_text"
    #: Ids from the whole path, so that equal names in different folders stay apart.
    path_in_id: bool = False
    #: Extracted tables hold the last run's files only.
    overwrite: bool = False
    #: Missing values stand as `nan` in the ids of mail rows, as in tables from before.
    legacy_nan_id: bool = False
