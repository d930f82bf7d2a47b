"""Secret spans, and weak parts of credentials that count only next to their complement.

Three kinds stand alone: assigned values, access key ids and long hex strings.  Three more are weak:
an *identifier* (account or client name), a *secret* (an unlabelled mixed token) and an *endpoint*
(URL, host or address with port).  Within one scope (a paragraph, ended by a blank line) parts are
interval-joined to what stands at most ``REACH`` characters away: an identifier or endpoint counts
if a secret part is there, a weak secret if an identifier or endpoint is.  A weak part that overlaps
a span of the first three kinds is that span's own text and is dropped.

All of it is column expressions.  A text is split by each pattern, so gaps and matches alternate and
positions are running sums of their lengths; no text leaves the scan unless it is to be redacted.
The interval join sweeps each document in order of position (nearest part before and behind by
window functions), so no pairs are made and a document with very many parts costs n log n.

Positions are code points, ends exclusive.  Defined cases: null text is empty; an empty text has no
span; repeated rows are separate documents; an empty table gives no rows; other columns are kept by
``redact`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The three base kinds.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
LEAST_VALUE = 6

IDENTIFIER = (
    r"""(?i:access_?key_?id|client_?id|account|user_?name|login)"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
)
LEAST_WEAK = 20
WEAK_SECRET = f"[A-Za-z0-9+/_-]{{{LEAST_WEAK},}}"
ENDPOINT = (
    r"""https?://[A-Za-z0-9.-]+(?::[0-9]+)?|[0-9]{1,3}(?:[.][0-9]{1,3}){3}:[0-9]{2,5}|"""
    r"""(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{3,}"""
)
BREAK = r"\n[\x20\t\r]*\n"
REACH = 200

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
PATTERNS = (ASSIGN, ACCESS, HEX, IDENTIFIER, WEAK_SECRET, ENDPOINT)
BASE_KINDS = 3
SCOPE_END = len(KINDS)
DOCUMENT = -1
MARK = "struct<kind:int,nth:int,gap:int,size:int,good:boolean>"


def _marks(text: Column, kind: int, pattern: str) -> Column:
    """Each match of a pattern: its length, the text between it and the match before, if it counts."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    columns = [F.split(text, pattern, -1), matches]
    if kind == 0:
        columns.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)))
    both = F.arrays_zip(*[c.alias(f"c{i}") for i, c in enumerate(columns)])

    def good(x):
        if kind == 0:
            return F.char_length(x["c2"]) >= LEAST_VALUE
        if kind == 4:
            return x["c1"].rlike("[0-9]") & x["c1"].rlike("[A-Z]") & x["c1"].rlike("[a-z]")
        return F.lit(True)

    marks = F.transform(
        F.filter(both, lambda x: x["c1"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("nth"),
            F.char_length(x["c0"]).alias("gap"),
            F.char_length(x["c1"]).alias("size"),
            good(x).alias("good"),
        ),
    )
    return F.when(text.rlike(pattern), marks).otherwise(F.array().cast(f"array<{MARK}>"))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows (row, kind, start, end, scope, doc) of matches that count, and one row per document."""
    found = rows.withColumns(
        {f"m{k}": _marks(F.col("body"), k, p) for k, p in enumerate(PATTERNS)}
    )
    weak = sum((F.size(f"m{k}") for k in range(BASE_KINDS, len(KINDS))), F.lit(0)) > 0
    none = F.array().cast(f"array<{MARK}>")
    ends = F.when(weak, _marks(F.col("body"), SCOPE_END, BREAK)).otherwise(none)
    own = F.array(F.struct(
        F.lit(DOCUMENT).alias("kind"), F.lit(0).alias("nth"), F.lit(0).alias("gap"),
        F.lit(0).alias("size"), F.lit(True).alias("good")))
    marks = F.concat(own, *[F.col(f"m{k}") for k in range(len(KINDS))], ends)
    flat = found.select("row", "doc", F.inline(marks)).withColumn(
        "doc", F.when(F.col("kind") == DOCUMENT, F.col("doc"))
    )
    along = Window.partitionBy("row", "kind").orderBy("nth")
    through = Window.partitionBy("row").orderBy("start", "kind")
    until = F.sum(F.col("gap") + F.col("size")).over(along)
    return (
        flat.withColumn("end", until)
        .filter("good")
        .select("row", "doc", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
        .withColumn("scope", F.sum((F.col("kind") == SCOPE_END).cast("int")).over(through))
    )


def _linked(placed: DataFrame) -> DataFrame:
    """Without weak parts that overlap a base span or have no complement in reach."""
    kind, start, end = F.col("kind"), F.col("start"), F.col("end")
    is_base = kind.between(0, BASE_KINDS - 1)
    def sides(*by: str):
        """What stands before a row and behind it, the latter as what is before it from the other end.

        A frame that reaches to the end would be run through again for every row.
        """
        forward = Window.partitionBy(*by).orderBy("start", "kind")
        backward = Window.partitionBy(*by).orderBy(F.desc("start"), F.desc("kind"))
        return [w.rowsBetween(Window.unboundedPreceding, -1) for w in (forward, backward)]

    before, behind = sides("row")
    own = F.coalesce(F.max(F.when(is_base, end)).over(before) > start, F.lit(False)) | F.coalesce(
        F.min(F.when(is_base, start)).over(behind) < end, F.lit(False)
    )
    free = placed.withColumn("own", own).filter(is_base | ~F.col("own") | (kind == DOCUMENT))
    near_before, near_behind = sides("row", "scope")

    def reached(*kinds):
        wanted = kind.isin(*kinds)
        left = start - F.max(F.when(wanted, end)).over(near_before) <= REACH
        right = F.min(F.when(wanted, start)).over(near_behind) - end <= REACH
        return F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))

    secret, other = reached(0, 2, 4), reached(1, 3, 5)
    stays = is_base | (kind == DOCUMENT) | F.when(kind == 4, other).otherwise(secret)
    return free.withColumn("stays", stays).filter(F.col("stays") & (kind < SCOPE_END))


def _by_document(docs: DataFrame, carried: Column) -> DataFrame:
    """row, doc (the carried columns), its spans in order of start, then kind, and what lies between them.

    ``gaps`` has the end and begin of the text in front of every span that begins where no earlier one
    reaches, and ``last`` the end of the last span.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        carried.alias("doc"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("body"),
    )
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    reached = _linked(_placed(rows)).withColumn("reached", F.max("end").over(before))
    is_span = F.col("kind") >= 0
    span = F.when(is_span, F.struct("start", "kind", "end"))
    gap = F.when(is_span & (F.col("start") >= F.col("reached")), F.struct("start", "reached"))
    return reached.groupBy("row").agg(
        F.first("doc", ignorenulls=True).alias("doc"),
        F.sort_array(F.collect_list(span)).alias("spans"),
        F.sort_array(F.collect_list(gap)).alias("gaps"),
        F.max("end").alias("last"),
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: an array of (start, kind, end), kinds as positions in ``KINDS``."""
    found = _by_document(docs, F.struct(docs["doc_id"]))
    return found.select("doc.doc_id", "spans")


def linked_parts(docs: DataFrame) -> DataFrame:
    """doc_id, and spans (start, kind, end) of a secret with its identifier and endpoint.

    A row for each secret part (an assigned value, a hex string or a mixed token) that has an identifier
    (an access key id or a name) or an endpoint within ``REACH`` characters of its scope: the nearest of
    each, the one before it if both sides are as near, NULL if there is none.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(docs["doc_id"]).alias("doc"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("body"),
    )
    placed = _placed(rows)
    spans = placed.join(_linked(placed).select("row", "kind", "start"), ["row", "kind", "start"], "left_semi")
    forward = Window.partitionBy("row", "scope").orderBy("start", "kind")
    backward = Window.partitionBy("row", "scope").orderBy(F.desc("start"), F.desc("kind"))
    earlier, later = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (forward, backward))
    here = F.struct("start", "kind", "end")

    def nearest(*kinds: int) -> Column:
        wanted = F.col("kind").isin(*kinds)
        left = F.max(F.when(wanted, F.struct("end", here.alias("part")))).over(earlier)
        right = F.min(F.when(wanted, F.struct("start", here.alias("part")))).over(later)
        before = F.when(left.isNotNull(), F.greatest(F.col("start") - left["end"], F.lit(0)))
        behind = F.when(right.isNotNull(), F.greatest(right["start"] - F.col("end"), F.lit(0)))
        first = before <= F.least(F.coalesce(behind, before), F.lit(REACH))
        return F.when(F.coalesce(first, F.lit(False)), left["part"]).when(behind <= REACH, right["part"])

    linked = spans.withColumns({"identifier": nearest(1, 3), "endpoint": nearest(5)}).filter(
        F.col("kind").isin(0, 2, 4) & (F.col("identifier").isNotNull() | F.col("endpoint").isNotNull()))
    owners = placed.filter(F.col("kind") == DOCUMENT).select("row", "doc.doc_id")
    return owners.join(linked.select("row", here.alias("secret"), "identifier", "endpoint"), "row").drop("row")


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < BASE_KINDS)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark``; overlapping spans give one mark.

    A text with spans is widened to four bytes a character, so each piece between spans is cut out by its
    place: time grows with the text and the number of spans, not with their product.
    """
    found = _by_document(docs, F.struct(*[docs[c] for c in docs.columns]))
    text = F.col("doc.text").cast("string")

    def piece(wide: Column, begin: Column, end: Column) -> Column:
        cut = F.substring(wide, (begin * 4 + 1).cast("int"), ((end - begin) * 4).cast("int"))
        return F.decode(cut, "UTF-32")

    def joined(wide: Column) -> Column:
        pieces = F.transform("gaps", lambda g: piece(wide, g["reached"], g["start"]))
        rest = piece(wide, F.col("last"), F.char_length(text))
        return F.array_join(F.concat(pieces, F.array(rest)), mark)

    # As the variable of a lambda the widened text is made once, not for every piece.
    cleaned = F.when(F.size("spans") == 0, text).otherwise(
        F.transform(F.array(F.encode(text, "UTF-32")), joined)[0])
    return found.select(
        *[(cleaned if c == "text" else F.col("doc")[c]).alias(c) for c in docs.columns]
    )


SQL_MARK = """
  select row, {kind} as kind, nth, sum(length(gaps[nth]) + length(found[nth])) over
      (partition by row order by nth) as "end", length(found[nth]) as size, {good} as good
  from (select row, gaps, found, {more} unnest(range(1, len(found) + 1)) as nth from
    (select row, string_split_regex(body, '{pattern}') as gaps,
       regexp_extract_all(body, '{pattern}', 0) as found {values} from texts))"""


def sql() -> str:
    """The same in SQL, for DuckDB, with the same patterns."""
    goods = {0: f"length(vals[nth]) >= {LEAST_VALUE}", 4: "regexp_matches(found[nth], '[0-9]') and "
             "regexp_matches(found[nth], '[A-Z]') and regexp_matches(found[nth], '[a-z]')"}
    parts = []
    for kind, pattern in enumerate((*PATTERNS, BREAK)):
        quoted = pattern.replace("'", "''")
        parts.append(SQL_MARK.format(
            kind=kind, pattern=quoted, good=goods.get(kind, "true"),
            more="vals," if kind == 0 else "",
            values=f", regexp_extract_all(body, '{quoted}', 2) as vals" if kind == 0 else "",
        ))
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"""
with texts as (
  select row_number() over () as row, doc_id, coalesce(text, '') as body from documents
), marks as ({" union all ".join(parts)}
), placed as (
  select row, kind, "end" - size as start, "end",
    sum(case when kind = {SCOPE_END} then 1 else 0 end)
      over (partition by row order by "end" - size, kind) as scope
  from marks where good
), free as (
  select * from (
    select *, coalesce(max(case when kind < 3 then "end" end) over before > start, false)
        or coalesce(min(case when kind < 3 then start end) over behind < "end", false) as own
    from placed
    window before as (partition by row order by start, kind
        rows between unbounded preceding and 1 preceding),
      behind as (partition by row order by start, kind
        rows between 1 following and unbounded following))
  where kind < 3 or not own
), linked as (
  select *,
    coalesce(start - max(case when kind in (0, 2, 4) then "end" end) over before <= {REACH}, false)
    or coalesce(min(case when kind in (0, 2, 4) then start end) over behind - "end" <= {REACH},
      false) as by_secret,
    coalesce(start - max(case when kind in (1, 3, 5) then "end" end) over before <= {REACH}, false)
    or coalesce(min(case when kind in (1, 3, 5) then start end) over behind - "end" <= {REACH},
      false) as by_other
  from free
  window before as (partition by row, scope order by start, kind
      rows between unbounded preceding and 1 preceding),
    behind as (partition by row, scope order by start, kind
      rows between 1 following and unbounded following)
), spans as (
  select row, start, kind, [{names}][kind + 1] || ':' || start || ':' || "end" as span
  from linked where kind < {SCOPE_END}
    and (kind < 3 or case when kind = 4 then by_other else by_secret end)
), lists as (
  select row, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
    count(*) filter (kind = 2) as n_hex,
    string_agg(span, ',' order by start, kind) filter (kind < 3) as base,
    string_agg(span, ',' order by start, kind) as spans
  from spans group by row
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans
from texts left join lists using (row)"""
