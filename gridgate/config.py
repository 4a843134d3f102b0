"""Description of one intake run, checked when it is built."""

from __future__ import annotations

from dataclasses import dataclass, field

from gridgate.errors import ConfigurationError

# Accepted choices of a run.
DIALECTS = ("gp", "ch")
DIALECT_ALIASES = {
    "gp": "gp", "greenplum": "gp", "postgres": "gp", "postgresql": "gp",
    "ch": "ch", "clickhouse": "ch",
}
ERROR_MODES = ("raise", "coerce", "ignore", "verify")
DUMP_TYPES = ("sql", "csv")
TIMESTAMP_COLUMNS = ("write_ts", "load_dttm")
FILE_EXPORTS = ("csv", "sql")
TABLE_EXPORTS = ("append", "truncate_load", "via_backup")
CONTRACT_POLICIES = ("bd", "ods_template", "user_string", "none")
PLACEHOLDER_TABLE = "table_name"
PLACEHOLDER_SCHEME = "scheme_name"
ENCODINGS = (
    "utf-8", "utf-16", "utf-16-le", "utf-16-be",
    "ascii", "latin1", "cp1252", "cp1251", "cp866",
    "koi8-r", "koi8-u", "iso-8859-5",
    "gbk", "big5", "shift_jis", "euc-jp", "euc-kr",
)
# Names of the same charsets on the JVM.
JVM_CHARSETS = {
    "utf-8": "UTF-8", "utf-16": "UTF-16", "utf-16-le": "UTF-16LE",
    "utf-16-be": "UTF-16BE", "ascii": "US-ASCII", "latin1": "ISO-8859-1",
    "cp1252": "windows-1252", "cp1251": "windows-1251", "cp866": "IBM866",
    "koi8-r": "KOI8-R", "koi8-u": "KOI8-U", "iso-8859-5": "ISO-8859-5",
    "gbk": "GBK", "big5": "Big5", "shift_jis": "Shift_JIS",
    "euc-jp": "EUC-JP", "euc-kr": "EUC-KR",
}


def dialect_of(name: str) -> str:
    """``gp`` or ``ch`` for any accepted spelling of a target database."""
    key = (name or "").strip().lower()
    if key not in DIALECT_ALIASES:
        raise ConfigurationError(f"unknown dialect {name!r}, expected one of {DIALECTS}")
    return DIALECT_ALIASES[key]


@dataclass(frozen=True)
class IntakeConfig:
    """What to read, how to check it and where to publish it.

    ``source`` is a file, a folder or a glob; all files of one run share a
    header layout. ``export`` picks the sink: ``csv``/``sql`` write files below
    ``output_dir``, the table modes write ``scheme_name.table_name``.
    """

    source: str
    dialect: str = "gp"
    export: str = "sql"
    error_mode: str = "ignore"
    policy: str = "none"
    dtypes: dict[str, str] | None = None
    ddl: str | None = None
    key_columns: tuple[str, ...] = ()
    table_name: str = PLACEHOLDER_TABLE
    scheme_name: str = PLACEHOLDER_SCHEME
    output_dir: str | None = None
    report_dir: str | None = None
    report_values: bool = False
    sheet_name: str | None = None
    delimiter: str = ","
    quoted_newlines: bool = False
    encoding_input: str = "utf-8"
    encoding_output: str = "utf-8"
    skip_rows: int = 0
    skip_cols: int = 0
    max_row: int | None = None
    strip: bool = False
    blank_to_null: bool = True
    timestamp: str | None = None
    source_name_column: bool = False
    batch_size: int = 500
    #: Quote every value of a dump that is not NULL.
    quote_all: bool = False
    #: What ends a statement of a dump; whole_files reads files in which texts hold it.
    dump_separator: str = ";\n"
    whole_files: bool = False
    #: Rows of each file that types are inferred from; None takes all of them.
    infer_rows: int | None = None
    rule_options: dict = field(default_factory=dict)

    def __post_init__(self):
        object.__setattr__(self, "dialect", dialect_of(self.dialect))
        checks = [
            (bool(self.source), "source must not be empty"),
            (self.export in FILE_EXPORTS + TABLE_EXPORTS, f"unknown export {self.export!r}"),
            (self.error_mode in ERROR_MODES, f"unknown error_mode {self.error_mode!r}"),
            (self.policy in CONTRACT_POLICIES, f"unknown policy {self.policy!r}"),
            (bool(self.dump_separator), "dump_separator must not be empty"),
            (self.batch_size > 0, f"batch_size must be positive, got {self.batch_size}"),
            (self.skip_rows >= 0, f"skip_rows must be >= 0, got {self.skip_rows}"),
            (self.skip_cols >= 0, f"skip_cols must be >= 0, got {self.skip_cols}"),
            (self.max_row is None or self.max_row > 0, f"max_row must be positive, got {self.max_row}"),
            (self.encoding_input.lower() in ENCODINGS, f"unsupported encoding {self.encoding_input!r}"),
            (self.encoding_output.lower() in ENCODINGS, f"unsupported encoding {self.encoding_output!r}"),
            (self.timestamp in (None, "none") + TIMESTAMP_COLUMNS, f"unknown timestamp column {self.timestamp!r}"),
            (self.policy != "user_string" or bool((self.ddl or "").strip()), "policy user_string needs ddl"),
        ]
        for ok, problem in checks:
            if not ok:
                raise ConfigurationError(problem)

    @property
    def timestamp_column(self) -> str | None:
        return None if self.timestamp in (None, "none") else self.timestamp

    @property
    def target(self) -> str:
        return f"{self.scheme_name}.{self.table_name}"
