"""Run configuration: rule lists, table names and column choices.

Everything a bank deployment edits lives here, so the operators stay pure
``DataFrame -> DataFrame`` functions.  The lists are plain tuples so a
config can be hashed, compared and passed to executors without surprises.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# These must equal the screening rules of the original job for
# results to match.  Listed as written, in their original order.
# ---------------------------------------------------------------------------

# Allowed transaction channels.
DEFAULT_CHANNELS = (
    "銀行資訊交換平台FEP跨行ATM",
    "網路銀行 行銀",
    "銀行資訊交換平台FEP匯款",
    "銀行資訊交換平台FEP自行ATM",
    "新端末",
    "網路銀行 網銀",
    "一卡通",
)

# Allowed transaction memos (the "ＣＤ" prefix is full-width).
DEFAULT_MEMOS = (
    "ＣＤ轉收", "ＣＤ提款", "行動跨轉", "匯入款", "行動自轉", "網路跨轉", "ＣＤ轉支", "跨行存款",
    "ＣＤ存現", "領現", "轉支", "提領", "主動儲值", "轉收", "ＣＤ轉帳", "儲值",
    "跨國提款", "網路自轉", "行動換匯", "無卡提款", "付款", "國外匯入", "自動儲值", "國外匯出",
)

# Remarks whose transactions are removed (a null remark is kept).
DEFAULT_REMOVED_REMARKS = ("信用卡", "基金", "學貸", "房", "房貸")

# Teller codes: characters 4-7 of emp_no, or character 4 equal to '3'.
DEFAULT_TELLER_CODES = (
    "4001", "4002", "4005", "4011", "4012", "4013", "4014",
    "4021", "4022", "4111", "4112", "4115", "4215",
)
DEFAULT_TELLER_PREFIX = "3"

# Excluded professions and the age limit of excluded customers.
DEFAULT_OCCUPATIONS = ("20", "25", "26")
DEFAULT_MAX_EXCLUDED_AGE = 10

# Online-banking menu codes and the category each one counts toward.
DEFAULT_MB_CHECK_MENUS = ("MDS01", "MDS0101", "MDS04", "MDS0401", "MDS0402")
DEFAULT_MB_LIMIT_MENUS = ("MPS1302",)
DEFAULT_EB_CHECK_MENUS = ("CDS0401", "CDS04", "CDS01", "CDS0102", "CBO03", "CDF02", "CDF04")

# Custody-code prefix of brokerage accounts (a placeholder in the original job).
DEFAULT_BROKER_PREFIX = "XX"

# The 18 transaction columns carried by the candidate selection.
DEFAULT_TXN_COLUMNS = (
    "acct_nbr_ori", "acct_nbr", "act_date", "tx_date", "tx_time", "drcr", "cust_id",
    "own_trans_acct", "tx_amt", "pb_bal", "tx_brh", "cur", "channel_desc", "chal_1",
    "memo", "remk", "jrnl_no", "tx_mode",
)

# Output names of the three access-count categories (lower case).
MB_LIMIT = "mb_limit"
MB_CHECK = "mb_check"
EB_CHECK = "eb_check"
ACCESS_CATEGORIES = (MB_LIMIT, MB_CHECK, EB_CHECK)


@dataclass(frozen=True)
class ScreenConfig:
    """Rule lists and column choices of one screening run."""

    channels: tuple[str, ...] = DEFAULT_CHANNELS
    memos: tuple[str, ...] = DEFAULT_MEMOS
    removed_remarks: tuple[str, ...] = DEFAULT_REMOVED_REMARKS
    teller_codes: tuple[str, ...] = DEFAULT_TELLER_CODES
    teller_prefix: str = DEFAULT_TELLER_PREFIX
    occupations: tuple[str, ...] = DEFAULT_OCCUPATIONS
    max_excluded_age: int = DEFAULT_MAX_EXCLUDED_AGE
    mb_check_menus: tuple[str, ...] = DEFAULT_MB_CHECK_MENUS
    mb_limit_menus: tuple[str, ...] = DEFAULT_MB_LIMIT_MENUS
    eb_check_menus: tuple[str, ...] = DEFAULT_EB_CHECK_MENUS
    broker_prefix: str = DEFAULT_BROKER_PREFIX
    txn_columns: tuple[str, ...] = DEFAULT_TXN_COLUMNS
    tx_mode: str | None = "1"
    currency: str = "TWD"
    account_width: int = 14
    # Null-aware NOT IN (SQL semantics) for the two exclusion lists.
    null_aware_exclusions: bool = True
    # Look the lists' keys up in a table of bits first, so that rows on no list are not shuffled.
    prefilter_lists: bool = False
    # Keys of the optional registered-transfer lookup: (txn column, table column).
    registered_keys: tuple[tuple[str, str], ...] = field(default=())
    # Columns taken from that table, in the order that picks one row per key.
    registered_columns: tuple[str, ...] = ()
    # The logs' own day column for the range test (None: the day of access_time).
    log_day_column: str | None = None

    def with_(self, **changes) -> "ScreenConfig":
        return replace(self, **changes)


@dataclass(frozen=True)
class TableNames:
    """Where the inputs live: metastore names, Parquet paths, or JDBC options
    (a mapping with ``url``, ``query`` and the other arguments of
    ``read_jdbc``).  The defaults are placeholder view names."""

    savings_txn: str | dict = "savings_txn"
    customers: str | dict = "customers"
    account_flags: str | dict = "account_flags"
    brokerage_links: str | dict = "brokerage_links"
    mobile_log: str | dict = "mobile_log"
    web_log: str | dict = "web_log"
    account_snapshot: str | dict = "account_snapshot"
    registered: str | dict | None = None
