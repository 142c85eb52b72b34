"""Parameters in one place.

``Fixed`` values are part of the diagnosed platform's own rules. ``Ours`` are defaults chosen here
for diagnoses that are described only in words; every operator takes them as arguments.
"""

MIB = 1024**2
GIB = 1024**3
TIB = 1024**4


class Fixed:
    WAREHOUSE = "/user/hive/warehouse"
    HEADER_PATH = "Path"
    NEVER_ACCESSED = "1970-01-01 08:00:00"
    UNREPLICATED = 16020  # replication value that marks a directory-like record
    STALE_YEARS = 5
    TOUCHED_DAYS = 7
    RETENTION_DAYS = 60
    MIN_CARDINALITY = 10_000_000
    MAX_HOPS = 13
    CUTOFF = "06:00:00"
    EXCLUDED_PROJECTS = (1, 2, 3, 4, 18, 20, 31, 33)
    LONG_FAILURE_DAYS = 10
    LONG_RUN_SECONDS = 2 * 3600
    FIRST_FAILURE_RETRIES = 1
    MONTHS_KEPT_REPORT = 13
    MONTHS_KEPT_TASKS = 6
    MONTHS_AHEAD = 1
    CONTAINS = "包含"
    DEPENDS = "依赖"
    TOP_LEVEL = "一级"


class Ours:
    FILE_BYTES = 128 * MIB  # size that files of tables are brought to
    HISTORY_RUNS = 14
    # How far back these runs are looked for when a range of days is judged; None: all days.
    HISTORY_DAYS = None
    END_SHIFT_SECONDS = 30 * 60
    DURATION_HIGH = 2.0
    DURATION_LOW = 0.5
    MEMORY_USED_MIN = 0.3
    CPU_USED_MIN = 0.3
    LARGE_SCAN_ROWS = 10_000_000
    BROADCAST_SHARE = 0.3
    SKEW_RATIO = 5
    TAIL_RATIO = 5
    IDLE_SHARE = 0.3
    STALL_SHARE = 0.1
    SPECULATION_SHARE = 0.1
    GC_SHARE = 0.1
    SORT_STAGE_MS = 30 * 60 * 1000
    TABLET_MIN_BYTES = 100 * MIB
    TABLET_MAX_BYTES = 10 * GIB
    PARTITION_MIN_BYTES = 100 * MIB
    PARTITION_MAX_BYTES = 100 * GIB
    SQL_FAILURE = r"AnalysisException|ParseException|SparkSQLException|NoSuchTableException|cannot resolve"
    SHUFFLE_FAILURE = r"FetchFailed|MetadataFetchFailed|shuffle|Shuffle"
    OOM_FAILURE = r"OutOfMemoryError|Container killed .* exceeding memory|Java heap space|GC overhead limit"
