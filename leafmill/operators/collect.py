"""Collection: payload checks, file names, URL resolution, the decision for every planned file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .state import orphans

# Payload limits and the statuses of the decision ladder.
MIN_BYTES, SNIFF_BYTES, HTML_BYTES = 10_000, 1024, 512
COLLECTIBLE = ("approved", "conditional")
DEFAULT_TAG, RESTRICTED = "DO_NOT_COLLECT", "RESTRICTED"
#: Attempts of a request, the waits between them in seconds, and the answers that end it at once.
RETRY = {"attempts": 3, "waits": (5, 10), "final": (403, 404, 410)}


def detect_type(payload: Column) -> Column:
    """pdf, html, json or unknown from the first bytes of a binary column."""
    head = F.decode(F.substring(payload, 1, SNIFF_BYTES), "ISO-8859-1")
    head = F.regexp_replace(head, r"^[ \t\n\r\x0b\x0c]+", "")
    low = F.lower(F.substring(head, 1, HTML_BYTES))
    return (
        F.when(head.startswith("%PDF-"), "pdf").when(low.startswith("<!doctype") | low.contains("<html"), "html").when(head.startswith("{") | head.startswith("["), "json").otherwise("unknown")
    )


def validate_payload(payload: Column, expected: str = "pdf") -> Column:
    """struct<ok, detected, detail>: an HTML page, too few bytes or another type is refused, in that order."""
    kind, size = detect_type(payload), F.octet_length(payload)
    refusal = F.when(kind == "html", F.lit("rejected: HTML page received where a document was expected (error/placeholder page)"))
    refusal = refusal.when(size < MIN_BYTES, F.concat(F.lit("rejected: payload too small ("), size.cast("string"), F.lit(f" bytes < {MIN_BYTES})")))
    if expected == "pdf":
        refusal = refusal.when(kind != "pdf", F.concat(F.lit("rejected: expected PDF magic bytes, got '"), kind, F.lit("'")))
    return F.struct(refusal.isNull().alias("ok"), kind.alias("detected"), F.coalesce(refusal, F.lit("ok: magic-bytes and size checks passed")).alias("detail"))


def safe_filename(name: Column) -> Column:
    """Percent escapes decoded (where valid; + kept), then everything but letters, digits, dot, underscore and hyphen replaced."""
    plus = F.regexp_replace(name, r"\+", "%2B")
    return F.regexp_replace(F.coalesce(F.try_url_decode(plus), name), r"[^A-Za-z0-9._-]", "_")


def last_part(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def resolve_direct(sources: DataFrame) -> DataFrame:
    """id, url, filename of every address in file_urls."""
    return sources.select("id", F.explode("file_urls").alias("url")).withColumn("filename", safe_filename(last_part(F.col("url"))))


def best_derivative(files: DataFrame, key: str = "item_id") -> DataFrame:
    """One PDF of each item: the first listed with format Text PDF, else the largest, the first of equals.

    files: key, pos, name, format, size (text).  An item without a PDF has the
    reason in `error`, which is null otherwise, and no file.
    """
    pdf = F.lower("name").endswith(".pdf")
    size = F.coalesce(F.when(F.col("format") == "Text PDF", F.lit(None)).otherwise(F.col("size").try_cast("long")), F.lit(0))
    rank = F.struct((F.col("format").eqNullSafe("Text PDF")).cast("int"), size, -F.col("pos"))
    error = F.when(F.col("f").isNull(), F.concat(F.lit("no PDF derivative found for archive item "), F.col(key).cast("string")))
    best = files.groupBy(key).agg(F.max_by(F.when(pdf, F.struct("name", "format", "size")), F.when(pdf, rank)).alias("f"))
    return best.select(key, "f.*", safe_filename(F.col("f.name")).alias("filename"), error.alias("error"))


def absolute(base: Column, href: Column) -> Column:
    """The address that href means on page base: absolute, scheme-relative, host-relative or relative."""
    scheme, host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.regexp_extract(base, r"^[^:]+://([^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^[^:]+://[^/?#]*([^?#]*/)", 1)
    root = F.concat(scheme, F.lit("://"), host)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, F.lit(":"), href)).when(href.startswith("/"), F.concat(root, href))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), href))
    )


def extract_links(pages: DataFrame, suffix: str = r"\.pdf", name_part: str = "practice-test", html: str = "html", url: str = "url") -> DataFrame:
    """page_id, link, filename of the distinct links on each page that end in `suffix` and whose file name holds `name_part`."""
    pattern = f'(?i)href="([^"]+?{suffix})"'
    hrefs = F.array_sort(F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))))
    out = pages.select("page_id", F.col(url).alias("_base"), F.explode(hrefs).alias("href")).withColumn("link", absolute(F.col("_base"), F.col("href")))
    out = out.withColumn("filename", safe_filename(last_part(F.col("link"))))
    return out.where(F.lower("filename").contains(name_part)).select("page_id", "link", "filename")


def unquoted(x: Column) -> Column:
    """Percent escapes decoded as UTF-8; what is no escape stays as it is."""
    return F.try_url_decode(F.regexp_replace(F.replace(x, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25"))


def quoted(x: Column) -> Column:
    """Everything but letters, digits and _.-~/ as percent escapes."""
    out = F.url_encode(x)
    for theirs, ours in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(theirs), F.lit(ours))
    return out


def _tidy(path: Column) -> Column:
    """A path without an empty fragment, query or parameter part."""
    out = F.regexp_replace(path, "(?s)^([^#]*)#$", "$1")
    out = F.regexp_replace(out, r"(?s)^([^?#]*)\?(#|$)", "$1$2")
    return F.regexp_replace(out, "(?s)^((?:[^?#]*/)?[^;?#/]*);([?#]|$)", "$1$2")


def robots_path(url: Column) -> Column:
    """What rules are held against: an address without scheme and host, its escapes in one spelling; / where nothing is left."""
    rest = F.regexp_extract(unquoted(url), r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?(.*)$", 1)
    path = quoted(_tidy(rest))
    return F.when(path == "", F.lit("/")).otherwise(path)


def robots_gate(urls: DataFrame, robots: DataFrame) -> DataFrame:
    """`urls` (url) with allowed and note, from what is known of each host.

    robots: host, http_status (null: unreachable), rules array<struct<allow
    boolean, path string>> in the order of the file, as `robots_rules` gives them.
    A 404 opens the host; any other failure closes it; else the first rule whose
    path starts the address's path decides, and without one it is open.  Unknown
    hosts, and addresses that are null or name none, are closed.
    """
    at = urls.withColumns({"host": F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")), "_path": robots_path(F.col("url"))})
    joined = at.join(robots.where("host <> ''"), "host", "left")
    rule = F.get(F.filter("rules", lambda r: F.col("_path").startswith(r["path"])), F.lit(0))
    status = F.col("http_status")
    allowed = F.when(status == 404, True).when(status == 200, F.coalesce(rule["allow"], F.lit(True))).otherwise(False)
    note = F.when(status == 404, "no robots.txt (404): allowed").when(status == 200, "robots.txt fetched and parsed").when(status.isNotNull(), F.concat(F.lit("robots.txt HTTP "), status.cast("string"), F.lit(": treating host as closed to automation"))).otherwise("robots.txt unreachable: treating host as closed to automation")
    return joined.withColumns({"allowed": allowed, "note": note}).drop("_path", "rules", "http_status")


def robots_rules(files: DataFrame, agent: str) -> DataFrame:
    """`files` (host, http_status, body) with rules in place of body: what robots.txt says to an agent.

    A group is a run of agent lines with the rules after it, up to an empty line or the next agent; it
    counts if it has a rule.  The first group that names a part of our agent holds, else the first for `*`.
    An empty Disallow allows all.  Paths are spelled as `robots_path` spells addresses.
    """
    name = agent.split("/")[0].lower()
    kinds = {"user-agent": "agent", "allow": "rule", "disallow": "rule", "crawl-delay": "delay", "request-rate": "delay"}

    def line(x: Column) -> Column:
        said = t.strip(F.substring_index(x, "#", 1))
        key = F.lower(t.strip(F.substring_index(said, ":", 1)))
        known = F.create_map(*[F.lit(v) for kv in kinds.items() for v in kv])
        value = unquoted(t.strip(F.regexp_extract(said, "(?s)^[^:]*:(.*)$", 1)))
        kind = F.when(x == "", "end").when(said.contains(":"), F.try_element_at(known, key))
        path = quoted(_tidy(value))
        return F.struct(kind.alias("kind"), value.alias("agent"), ((key == "allow") | (value == "")).alias("allow"), path.alias("path"))

    rows = files.select("host", F.col("http_status").cast("int").alias("http_status"), F.filter(F.transform(t.lines(F.coalesce("body", F.lit(""))), line), lambda x: x["kind"].isNotNull()).alias("_lines"))
    lines = F.col("_lines")
    opens = F.array_compact(F.transform(lines, lambda x, i: F.when((x["kind"] == "agent") & ~F.coalesce(F.get(lines, i - 1)["kind"] == "agent", F.lit(False)), i)))
    rows = rows.withColumn("_opens", opens)
    whole = F.transform("_opens", lambda o, k: F.slice(lines, o + 1, F.coalesce(F.get(F.col("_opens"), k + 1), F.size(lines)) - o))
    rows = rows.withColumn("_groups", whole)
    cut = F.transform("_groups", lambda g: F.slice(g, 1, F.coalesce(F.nullif(F.array_position(F.transform(g, lambda x: x["kind"]), "end"), F.lit(0)) - 1, F.size(g)).cast("int")))
    rows = rows.withColumn("_groups", F.filter(cut, lambda g: F.exists(g, lambda x: x["kind"].isin("rule", "delay"))))
    every = lambda g: F.exists(g, lambda x: (x["kind"] == "agent") & (x["agent"] == "*"))
    ours = lambda g: ~every(g) & F.exists(g, lambda x: (x["kind"] == "agent") & F.contains(F.lit(name), F.lower(x["agent"])))
    group = F.coalesce(F.get(F.filter("_groups", ours), F.lit(0)), F.get(F.filter("_groups", every), F.lit(0)))
    rules = F.transform(F.filter("_group", lambda x: x["kind"] == "rule"), lambda x: F.struct(x["allow"].alias("allow"), x["path"].alias("path")))
    return rows.withColumn("_group", group).select("host", "http_status", F.coalesce(rules, F.array().cast("array<struct<allow: boolean, path: string>>")).alias("rules"))


def eligible(sources: DataFrame) -> DataFrame:
    return sources.where(F.col("status").isin(*COLLECTIBLE))


def collection_status(facts: DataFrame) -> DataFrame:
    """`facts` with ledger_status: the first rule of the ladder that holds.

    facts: method, source_status, owner_signoff, resolve_error, robots_blocked_page,
    already_verified, robots_allowed, download_error, payload_ok.  `no_row` is a
    conditional source without sign-off, which leaves no ledger row.
    """
    status = (
        F.when(F.coalesce(F.col("method"), F.lit("skip")) == "skip", "skipped")
        .when((F.col("source_status") == "conditional") & ~F.coalesce("owner_signoff", F.lit(False)), "no_row")
        .when(F.coalesce("robots_blocked_page", F.lit(False)), "blocked_robots")
        .when(F.col("resolve_error").isNotNull(), "failed")
        .when(F.coalesce("already_verified", F.lit(False)), "verified")
        .when(~F.coalesce("robots_allowed", F.lit(False)), "blocked_robots")
        .when(F.col("download_error").isNotNull(), "failed")
        .when(~F.coalesce("payload_ok", F.lit(False)), "failed")
        .otherwise("collected")
    )
    return facts.withColumn("ledger_status", status)


def manual_intake(files: DataFrame, sources: DataFrame) -> DataFrame:
    """Ledger rows of inbox files (folder, name, content) of eligible sources that pass the payload check."""
    known = eligible(sources).select(F.col("id").alias("folder"), "landing_url", F.coalesce("usage_tag", F.lit(DEFAULT_TAG)).alias("usage_tag"))
    checked = files.where(F.lower("name").endswith(".pdf")).join(known, "folder").withColumns({"_v": validate_payload(F.col("content")), "filename": safe_filename(F.col("name"))}).where("_v.ok")
    return checked.select(
        F.col("folder").alias("source_id"), F.concat(F.lit("manual-download:"), F.coalesce("landing_url", F.lit("n/a")), F.lit("#"), F.col("filename")).alias("url"), "filename",
        F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("size_bytes"), F.col("_v.detected").alias("detected_type"), "usage_tag", F.lit("manual_intake").alias("status"),
    )


ADOPTED = "adopted by reconciliation: file was placed directly in the source folder (bypassing _inbox); validated and hashed on "


def reconcile(files: DataFrame, ledger: DataFrame, sources: DataFrame, now: str) -> DataFrame:
    """Ledger rows of PDF files in a source's own folder that the ledger does not name, with `ok` false where validation fails.

    files: source_id, name, local_path, content.  Sources of any status are known.
    """
    known = sources.select(F.col("id").alias("source_id"), "landing_url", F.coalesce("usage_tag", F.lit(DEFAULT_TAG)).alias("usage_tag"))
    new = orphans(files.where(F.col("name").endswith(".pdf")), ledger).join(known, "source_id").withColumn("_v", validate_payload(F.col("content")))
    return new.select(
        "source_id", F.concat(F.lit("manual-download:"), F.coalesce("landing_url", F.lit("n/a")), F.lit("#"), F.col("name")).alias("url"), F.col("name").alias("filename"), "local_path",
        F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("size_bytes"), F.lit("application/pdf (reconciled)").alias("content_type"), F.col("_v.detected").alias("detected_type"),
        "usage_tag", F.lit("manual_intake").alias("status"), F.when(F.col("_v.ok"), F.concat(F.lit(ADOPTED), F.lit(now))).otherwise(F.col("_v.detail")).alias("detail"), F.col("_v.ok").alias("ok"),
    )


def retry_after(attempt: Column, http_status: Column) -> Column:
    """Seconds to wait before the request is tried again after its attempt (from 1) failed; null: give up."""
    waits = F.array(*[F.lit(w) for w in RETRY["waits"]])
    return F.when(F.coalesce(http_status.isin(*RETRY["final"]), F.lit(False)) | (attempt >= RETRY["attempts"]), F.lit(None)).otherwise(F.get(waits, attempt - 1))


def registry_flat(sources: DataFrame) -> DataFrame:
    """One line for each source: defaults filled, evidence addresses joined."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return sources.select(
        "id", "name", text("publisher"), text("source_type"), "status", F.coalesce("usage_tag", F.lit(DEFAULT_TAG)).alias("usage_tag"), text("priority"), "license", "decision_reason",
        text("publication_year"), text("landing_url"), F.array_join("evidence.url", " | ").alias("evidence_urls"), "vetting_date",
    )


def headline(reason: Column) -> Column:
    return F.substring_index(reason, ".", 1)
