"""Names and folders of landed files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadledger.contract import CANONICAL, SeriesContract
from loadledger.functions.columns import column

# The file names and folder names a landing zone may hold.
HEX_ID = "[a-f0-9]{64}"
SEEN_AT = r"_at_\d{8}T\d{6}"
FILE_TAIL = r"(?:revisions/)?{prefix}_\d{{4}}-\d{{2}}-\d{{2}}(?:_(?:revision|sha256)_{hex})?\.json"
FOLDER_TAIL = r"version=(?:canonical|revision_{hex}(?:{seen})?)/part-[^/]+\.txt"
PART_FILE = r"/part-[^/]+\.txt$"


def landing_pattern(contract: SeriesContract) -> str:
    """Accepts one file per day with its revisions, and one folder per version."""
    files = FILE_TAIL.format(prefix=contract.file_prefix, hex=HEX_ID)
    folders = FOLDER_TAIL.format(hex=HEX_ID, seen=SEEN_AT)
    return rf"/day=\d{{2}}/(?:{files}|{folders})$"


def is_landing_path(path: Column | str, contract: SeriesContract) -> Column:
    return column(path).rlike(landing_pattern(contract))


def landing_folder(respondent: Column | str, date: Column | str) -> Column:
    """``respondent=US48/year=2026/month=09/day=26``"""
    return F.concat(
        F.lit("respondent="),
        column(respondent),
        F.date_format(column(date), "'/year='yyyy'/month='MM'/day='dd"),
    )


def canonical_name(date: Column | str, contract: SeriesContract) -> Column:
    return F.concat(
        F.lit(f"{contract.file_prefix}_"), F.date_format(column(date), "yyyy-MM-dd"), F.lit(".json")
    )


def revision_name(name: Column | str, revision_id: Column | str) -> Column:
    stem = F.regexp_replace(column(name), r"\.json$", "")
    return F.concat(stem, F.lit("_revision_"), column(revision_id), F.lit(".json"))


def source_of(path: Column | str) -> Column:
    """What identifies a landed version: the file, or the folder around a part file.

    Part files carry a random name, so it takes no part in keys and ordering.
    """
    return F.regexp_replace(column(path), PART_FILE, "")


def path_respondent(path: Column | str) -> Column:
    return F.regexp_extract(column(path), r"/respondent=([^/]+)/", 1)


def path_date(path: Column | str) -> Column:
    parts = r"/year=(\d{4})/month=(\d{2})/day=(\d{2})/"
    found = [F.regexp_extract(column(path), parts, group) for group in (1, 2, 3)]
    return F.concat_ws("-", *found).try_cast("date")


def path_revision_id(path: Column | str) -> Column:
    found = F.regexp_extract(column(path), rf"(?:revision|sha256)_({HEX_ID})", 1)
    return F.when(found != "", found)


def path_version(path: Column | str) -> Column:
    """``canonical`` or ``revision_<id>``; a version folder's own name wins."""
    folder = F.regexp_extract(column(path), r"/version=([^/]+)", 1)
    revision = path_revision_id(path)
    return (
        F.when(folder != "", folder)
        .when(revision.isNull(), F.lit(CANONICAL))
        .otherwise(F.concat(F.lit("revision_"), revision))
    )
