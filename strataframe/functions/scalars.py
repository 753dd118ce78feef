"""Scalar functions of tar headers, paths, names and times as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 512


def padded(size: Column, block: int = BLOCK) -> Column:
    return (F.floor((size + (block - 1)) / block) * block).cast("long")


def padding(size: Column, block: int = BLOCK) -> Column:
    return F.pmod(-size, F.lit(block)).cast("long")


def tar_size(field: Column) -> Column:
    """Size field of a tar header: octal text, or base-256 where the top bit is set; blank is 0."""
    text = F.trim(F.regexp_replace(field.cast("string"), "[\\x00 ]+", ""))
    octal = F.when(text == "", F.lit(0)).otherwise(F.conv(text, 8, 10).cast("long"))
    binary = F.conv(F.hex(F.substring(field, 2, 11)), 16, 10).cast("long")
    return F.when(F.conv(F.hex(F.substring(field, 1, 1)), 16, 10).cast("int") >= 128, binary).otherwise(octal)


def canonical_path(path: Column) -> Column:
    return F.lower(F.replace(path, F.lit("\\"), F.lit("/")))


def safe_name(name: Column) -> Column:
    """Whether a member name stays below the folder it is extracted to."""
    slashed = F.replace(name, F.lit("\\"), F.lit("/"))
    return (F.trim(slashed) != "") & ~slashed.startswith("/") & ~slashed.rlike("^[A-Za-z]:") & ~F.array_contains(F.split(slashed, "/"), "..")


def redacted(key: Column, value: Column) -> Column:
    return F.when(F.lower(key).rlike("secret|password|token|key"), F.lit("[redacted]")).otherwise(value)


def grouped_integer(text: Column) -> Column:
    """Integer with thousands separators."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("long")


def duration_seconds(size: Column, channels: Column, rate: Column, width: int = 2) -> Column:
    return F.try_divide(size.cast("double"), channels * rate * width)


def age_bucket(days: Column, limits: tuple[int, ...] = (7, 30, 90, 365)) -> Column:
    """Label of (previous limit, limit] that holds the age."""
    out = F.when(days <= limits[0], F.lit(f"<={limits[0]}"))
    for limit in limits[1:]:
        out = out.when(days <= limit, F.lit(f"<={limit}"))
    return out.otherwise(F.lit(f">{limits[-1]}"))


def member_kind(name: Column) -> Column:
    """Kind of an archive by the name of its first member; the first rule that holds: frame-N, basler-tiff, ome-tif, other-tiff, other."""
    tiff = name.rlike("\\.tiff?$")
    return F.when(name.rlike("^(.*/)?frame-[0-9]+$"), "frame-N").when(name.contains("Basler") & tiff, "basler-tiff").when(name.endswith(".ome.tif"), "ome-tif").when(tiff, "other-tiff").otherwise("other")


def archive_kind(first_member: Column, error: Column) -> Column:
    """The same with EMPTY and ERROR for archives without members or that couldn't be read."""
    return F.when(error == "EMPTY", "EMPTY").when(F.coalesce(error, F.lit("")) != "", "ERROR").otherwise(member_kind(first_member))


def band(name: Column) -> Column:
    """ap, lf or nidq by the suffix of a raw recording's name, else empty."""
    return F.regexp_extract(F.coalesce(name, F.lit("")), "\\.(ap|lf|nidq)\\.bin$", 1)


def session_parts(path: Column, root: str) -> Column:
    """(subject, date, session) of a path below ``root``; without a date of the form 2020-01-31 neither it nor the session is given. Outside all are empty."""
    base = root.rstrip("/") + "/"
    parts = F.split(F.substring(path, len(base) + 1, 1 << 20), "/")
    get = lambda k: F.coalesce(F.get(parts, F.lit(k)), F.lit(""))
    inside, dated = path.startswith(base), get(1).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    return F.struct(F.when(inside, get(0)).otherwise("").alias("subject"), F.when(inside & dated, get(1)).otherwise("").alias("date"), F.when(inside & dated, get(2)).otherwise("").alias("session"))


def last_parts(path: Column, n: int = 3) -> Column:
    """The last ``n`` folders of a file's path, joined by /."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - n, F.lit(1)), F.least(F.lit(n), F.size(parts) - 1)), "/")


def skip_reason(size: Column, coded: Column, has_meta: Column, channels: Column, rate: Column, width: int = 2) -> Column:
    """Why a recording isn't to be compressed, or null: the first that holds."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return (
        F.when(size.isNull(), "size unknown").when(F.coalesce(coded, F.lit(False)), "compressed already").when(no(has_meta), "no description")
        .when(no(channels > 0) | no(rate > 0), "no channels or rate").when(size % (width * channels) != 0, "no whole number of samples").when(size == 0, "empty")
    )


def blocked_geometry(kind: Column, rows: Column, cols: Column) -> Column:
    """Whether an archive can't be compressed: its frames have no header and nobody gave their shape."""
    return (kind == "frame-N") & ~(F.coalesce(rows, F.lit(0)) * F.coalesce(cols, F.lit(0)) > 0)


def ustar(header: Column) -> Column:
    """Whether a header has the ustar magic, in its POSIX or its GNU form."""
    return F.substring(header, 258, 6).isin(b"ustar\0", b"ustar ")


def name_contains(path: Column, part: str | None) -> Column:
    """Whether a path has ``part`` in it; with none, all do."""
    return F.lit(True) if part is None else path.contains(part)


def megabytes_per_second(size: Column, seconds: Column) -> Column:
    return F.try_divide(size / 1e6, seconds)


def percent_saved(source: Column, output: Column) -> Column:
    return 100 - F.try_divide(100.0 * output, source)


def bits_per_sample(output: Column, samples: Column) -> Column:
    return F.try_divide(8.0 * output, samples)


def days_needed(size: Column, mb_per_second: float) -> Column:
    return size / 1e6 / mb_per_second / 86_400


def cost(size: Column, per_million: float) -> Column:
    """What a size costs at a price for each million of its units."""
    return size / 1e6 * per_million


def old_enough(then: Column, now: Column, seconds: float) -> Column:
    """Whether something was last written to at least so many seconds ago."""
    return then <= now - F.make_dt_interval(secs=F.lit(seconds))


def transient(path: Column, mark: str = ".partial-") -> Column:
    """Whether a path is that of an unfinished file."""
    return path.contains(mark)


def recording_member(name: Column) -> Column:
    """(stem, trial, probe, bytes) of a listed member such as ``a/b_t0.imec0.ap.bin (12 bytes)``; null if it isn't one."""
    pattern = "([^/]+)_t([0-9]+)\\.imec([0-9]+)\\.ap\\.bin \\(([0-9,]+)"
    part = lambda k: F.regexp_extract(name, pattern, k)
    return F.when(part(1) != "", F.struct(part(1).alias("stem"), part(2).cast("int").alias("trial"), part(3).cast("int").alias("probe"), grouped_integer(part(4)).alias("bytes")))


def share_path(path: Column, root: str) -> Column:
    """A path with a drive letter, seen below ``root``; others as they are but with forward slashes."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(slashed.rlike("^.:/"), F.concat(F.lit(root.rstrip("/") + "/"), F.substring(slashed, 4, 1 << 20))).otherwise(slashed)


def object_key(path: Column, top: str) -> Column:
    """Key of a file offsite: what follows the folder ``top`` (in any case) behind ``top``; without it, what follows the first slash. Only the top is put in lower case."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    at = F.instr(F.lower(slashed), f"/{top.lower()}/")
    rest = F.when(at > 0, F.substring(slashed, at + len(top) + 2, F.lit(1 << 20))).otherwise(F.regexp_replace(slashed, "^[^/]*/", ""))
    return F.concat(F.lit(top.lower() + "/"), rest)


def age_days(then: Column, now: Column) -> Column:
    """Whole days between two times."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(then)) / 86_400).cast("int")


def age_hours(then: Column, now: Column) -> Column:
    return (F.unix_timestamp(now) - F.unix_timestamp(then)) / 3600


def ago(then: Column, now: Column) -> Column:
    """An age in words: minutes up to 90, then hours up to 48, then days."""
    minutes = F.floor((F.unix_timestamp(now) - F.unix_timestamp(then)) / 60)
    words = lambda n, unit: F.concat(n.cast("long").cast("string"), F.lit(f" {unit} ago"))
    return F.when(minutes < 90, words(minutes, "min")).when(minutes < 48 * 60, words(F.floor(minutes / 60), "h")).otherwise(words(F.floor(minutes / 1440), "days"))


def epoch_iso(epoch: Column, milliseconds: bool = False) -> Column:
    """Seconds or milliseconds since 1970 as 2020-01-31T12:00:00+00:00, in UTC whatever the session's zone is.

    Years have four digits at least and more from 10000 on, without a plus sign; those before year 0 have a minus sign.
    """
    seconds = F.floor(epoch / 1000) if milliseconds else epoch.cast("long")
    second = F.pmod(seconds, F.lit(86_400))
    day = F.date_from_unix_date(((seconds - second) / 86_400).cast("int"))
    year = F.year(day).cast("string")
    two = lambda n: F.lpad(F.floor(n).cast("string"), 2, "0")
    date = F.concat(F.when(F.year(day).between(0, 999), F.lpad(year, 4, "0")).otherwise(year), F.lit("-"), two(F.month(day)), F.lit("-"), two(F.dayofmonth(day)))
    return F.concat(date, F.lit("T"), two(second / 3600), F.lit(":"), two(second % 3600 / 60), F.lit(":"), two(second % 60), F.lit("+00:00"))


def map_get(values: Column, *keys: str, default=None) -> Column:
    """The first of the keys that a map has a value for, else ``default``."""
    return F.coalesce(*[F.try_element_at(values, F.lit(k)) for k in keys], F.lit(default))


def last_component(path: Column) -> Column:
    """What follows the last slash, a slash at the end left out."""
    return F.element_at(F.split(F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "/+$", ""), "/"), -1)


def provenance() -> Column:
    """Struct of the versions that make a result: this library's, Spark's, Python's, and the commit of the working folder, if it has one."""
    import platform
    import subprocess

    import pyspark

    import strataframe

    told = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, check=False)
    commit = told.stdout.strip() if told.returncode == 0 else None
    return F.struct(F.lit(strataframe.__version__).alias("version"), F.lit(commit).cast("string").alias("commit"), F.lit(pyspark.__version__).alias("spark"), F.lit(platform.python_version()).alias("python"))
