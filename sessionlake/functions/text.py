"""Text, display and format expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_blank(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def first_nonempty(*cols: Column, trim: bool = False) -> Column:
    """First value that is not blank, else ''."""
    out = F.coalesce(*[not_blank(c) for c in cols], F.lit(""))
    return F.trim(out) if trim else out


def first_given(*cols: Column) -> Column:
    """First value that is not the empty text, else ''."""
    return F.coalesce(*[F.when(c != "", c) for c in cols], F.lit(""))


def display(c: Column) -> Column:
    return F.coalesce(not_blank(c), F.lit("-"))


def display_source(kind: Column, instance: Column) -> Column:
    a, b = display(kind), display(instance)
    return F.when(a == "-", b).when(b == "-", a).otherwise(F.concat_ws("/", a, b))


def display_session(kind: Column, instance: Column, source_session: Column, key: Column) -> Column:
    suffix = F.coalesce(not_blank(F.trim(source_session)), F.when(F.char_length(key) > 8, F.right(key, F.lit(8))).otherwise(key))
    return F.concat(display_source(kind, instance), F.lit("#"), F.substring(suffix, 1, 12))


def clean_path(c: Column) -> Column:
    """Slashes collapsed, '.' steps and a trailing slash removed."""
    out = F.regexp_replace(c, r"/{2,}", "/")
    out = F.regexp_replace(out, r"(?:/\.)+(?=/|$)", "")
    return F.when(F.char_length(out) > 1, F.regexp_replace(out, r"/$", "")).otherwise(out)


def display_project(locator: Column, key: Column) -> Column:
    value = first_nonempty(locator, key, trim=True)
    clean = clean_path(value)
    parts = F.split(F.regexp_replace(clean, r"^/+|/+$", ""), "/")
    short = F.concat(F.lit(".../"), F.array_join(F.slice(parts, F.size(parts) - 1, F.lit(2)), "/"))
    return (F.when(value == "", "-").when(value.contains("://") | (F.char_length(value) <= 40), value)
            .when(F.size(parts) <= 2, clean).otherwise(short))


def session_status(failures: Column, incomplete: Column) -> Column:
    return F.when(failures > 0, "failed").when(incomplete > 0, "incomplete").otherwise("clean")


def command_status(status: Column, exit_code: Column) -> Column:
    return (F.when(exit_code != 0, "failed").when(status.isin("start_only", "finish_only"), "incomplete").otherwise("clean"))


def format_time(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("-"))


def format_millis(ms: Column) -> Column:
    """Largest whole unit; nothing or less is '0s'."""
    unit = lambda n, name: F.concat(F.floor(ms / n).cast("string"), F.lit(name))
    return (F.when(F.coalesce(ms, F.lit(0)) <= 0, "0s").when(ms < 1000, unit(1, "ms")).when(ms < 60_000, unit(1000, "s"))
            .when(ms < 3_600_000, unit(60_000, "m")).when(ms < 86_400_000, unit(3_600_000, "h")).otherwise(unit(86_400_000, "d")))


def format_age(ts: Column, as_of: Column) -> Column:
    ms = F.timestamp_diff("MILLISECOND", ts, as_of)
    return F.when(ts.isNull() | (as_of < ts), "-").when(ms < 1, "0ms").otherwise(format_millis(ms))


def format_bytes(n: Column) -> Column:
    unit = lambda size, name: F.concat(F.format_string("%.1f", F.bround(n / size, 1)), F.lit(f" {name}"))
    return (F.when(n <= 0, "0 B").when(n >= 1 << 30, unit(1 << 30, "GiB")).when(n >= 1 << 20, unit(1 << 20, "MiB"))
            .when(n >= 1024, unit(1024, "KiB")).otherwise(F.concat(n.cast("string"), F.lit(" B"))))


def format_range(low: Column, high: Column) -> Column:
    return F.when(low.isNull(), "-").otherwise(F.concat(low.cast("string"), F.lit(".."), high.cast("string")))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def preview(c: Column, limit: int = 96) -> Column:
    plain = collapse(F.replace(c, F.lit("```"), F.lit("")))
    return F.when(F.char_length(plain) <= limit, plain).otherwise(F.concat(F.rtrim(F.substring(plain, 1, limit - 1)), F.lit("…")))


def compact(c: Column, limit: int = 140) -> Column:
    plain = collapse(c)
    return F.when(F.char_length(plain) <= limit, plain).otherwise(F.concat(F.trim(F.substring(plain, 1, limit - 3)), F.lit("...")))


def unwrap_command(c: Column) -> Column:
    """The command inside a shell wrapper, without its quotes."""
    inner = F.regexp_replace(F.trim(c), r"^(?:/bin/)?(?:bash|sh) -lc ", "")
    return F.trim(F.regexp_replace(F.trim(inner), r"""^(['"])(.*)\1$""", "$2"))


# What the first informative line of a failure looks like.
ERROR_NEEDLES = [
    "error", "failed", "failure", "fatal", "missing", "panic", "unknown", "not found", "not installed", "cannot", "can't",
    "denied", "timeout", "timed out", "undefined", "invalid", "no required module", "no such file", "traceback",
    "exception", "cannot find", "permission denied",
]
ERROR_PREFIXES = ["/bin/", "bash:", "sh:", "sudo:"]
METADATA_PREFIXES = [
    "Command:", "Chunk ID:", "Wall time:", "Process exited with code", "Process exited with exit code",
    "Original token count:", "Output:", "stdout:", "stderr:", "Session ID:",
]
CONTINUATIONS = ["run ", "go ", "npm ", "pnpm ", "yarn ", "cargo "]


def _one_of(items: list[str], prefix: bool) -> str:
    body = "|".join(f"\\Q{x}\\E" for x in items)
    return f"^(?:{body})" if prefix else f"(?:{body})"


def failure_excerpt(raw: Column) -> Column:
    """The line of an output that tells what failed, with a continuation if it has one."""
    plain = F.trim(F.replace(F.coalesce(raw, F.lit("")), F.lit("\r\n"), F.lit("\n")))
    tail = F.trim(F.substring_index(plain, "\nOutput:\n", -1))
    body = F.when(plain.contains("\nOutput:\n") & (tail != ""), tail).otherwise(plain)
    lines = F.filter(F.transform(F.split(body, "\n"), lambda x: F.trim(x)),
                     lambda x: (x != "") & ~x.rlike(_one_of(METADATA_PREFIXES, True)))
    error = lambda x: F.lower(x).rlike(_one_of(ERROR_NEEDLES, False)) | F.lower(x).rlike(_one_of(ERROR_PREFIXES, True))
    hit = F.array_position(F.transform(lines, error), True).cast("int")
    line, after = F.get(lines, hit - 1), F.get(lines, hit)
    goes_on = after.isNotNull() & (line.endswith(":") | F.lower(after).rlike(_one_of(CONTINUATIONS, True)))
    first, second = F.get(lines, F.lit(0)), F.get(lines, F.lit(1))
    return (F.when(F.size(lines) == 0, "").when(hit > 0, F.when(goes_on, F.concat_ws(" ", line, after)).otherwise(line))
            .when(second.isNotNull() & first.endswith(":"), F.concat_ws(" ", first, second)).otherwise(first))
