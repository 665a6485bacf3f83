"""Schemas that drift between files: path-value maps, path-type statistics, changes and one typed table.

Every readable payload is a map from fields to values with their raw JSON types.  Types and presence are
aggregated per file - inside each batch first - and compared with the file before it in the same feed.  Only
the fields that went or came are compared by their data, to tell a renamed field from one removed and another
added.  The typed table takes its columns from known names and from the renames that the data show.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.core.tables import materialize

#: Share of the values of the smaller side that a renamed field must have in common with its old self.
RENAME_OVERLAP = 0.25

#: Names that the target fields go by in the deliveries, compared without case and separators.
FIELD_NAMES = {
    "project_id": ["project_id", "projectId", "op_ref", "Project Number", "ID_OPERATION", "identifier", "proj_no"],
    "project_name": ["project_name", "nombre_proyecto", "name_en", "projectName", "title", "intitule"],
    "approval_date": ["approval_date", "approved_on", "fecha_aprobacion", "APPR_DT", "date_approved", "boardApprovalDate"],
    "completion_date": ["completion_date", "Closing Date"],
    "country": ["country", "countryshortname", "pais", "Economy"],
    "status": ["status", "stage", "activity_status"],
    "sector": ["sector", "major_sector", "secteur"],
    "loan_amount": ["loan_amount", "montant", "curr_commitment", "Amount"],
    "loan_currency": ["loan_currency", "currency_code", "Ccy"],
}
FIELD_KINDS = {"approval_date": "date", "completion_date": "date", "loan_amount": "amount"}


#: Files with fields to compare up to which their list is broadcast (some 10 MB); beyond, lines are joined to it.
BROADCAST_FILES = 50_000
#: Longer values are compared by a digest.
LONGEST = 64


def path_values(payload: str | None, literal: Callable = float) -> dict | None:
    """The fields of a line; None for a line that is null, blank, broken or not an object.

    A key repeated in a line counts as it stands last.  ``literal`` makes the numbers.
    """
    try:
        obj = json.loads(payload, parse_int=literal, parse_float=literal, parse_constant=literal) if payload else None
    except (ValueError, RecursionError):
        return None
    return obj if isinstance(obj, dict) else None


def json_type(v: object) -> str | None:
    """string, number, boolean, object or array; None for a JSON null."""
    return _TYPES.get(type(v))


def text_of(v: object) -> str | None:
    """A value as text: numbers as they are written, objects and arrays as JSON."""
    return v if v is None or type(v) is str else str(v) if isinstance(v, _Literal) else json.dumps(v, ensure_ascii=False)


class _Literal(str):
    """A number as it is written."""

    __slots__ = ()


_TYPES = {str: "string", dict: "object", list: "array", bool: "boolean", float: "number", _Literal: "number"}


def _day(text: Column) -> Column:
    """ISO text of a day in any of the notations; null if it is none."""
    iso = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})(?:$|[T ])", 1)
    dmy = F.regexp_replace(F.regexp_extract(text, r"^(\d{2}/\d{2}/\d{4})$", 1), r"(\d{2})/(\d{2})/(\d{4})", "$3-$2-$1")
    millis = F.regexp_extract(text, r"^-?\d{11,13}$", 0).try_cast("bigint")
    epoch = F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd")
    return F.coalesce(F.nullif(iso, F.lit("")), F.nullif(dmy, F.lit("")), epoch)


def _number(text: Column) -> Column:
    """A number in plain, grouped or worded notation as double; null if it is none."""
    plain = F.regexp_replace(F.regexp_extract(text, r"(?i)^\s*(-?[\d,]*\.?\d+(?:E-?\d+)?)\s*(?:million|mn|m)?\s*$", 1), ",", "").try_cast("double")
    return F.when(F.lower(text).rlike(r"(million|mn|m)\s*$"), plain * 1e6).otherwise(plain)


_ISO, _DMY, _EPOCH = re.compile(r"(\d{4}-\d{2}-\d{2})(?:$|[T ])"), re.compile(r"(\d{2})/(\d{2})/(\d{4})$"), re.compile(r"-?\d{11,13}$")
_AMOUNT = re.compile(r"(?i)\s*(-?[\d,]*\.?\d+(?:e-?\d+)?)\s*(million|mn|m)?\s*$")


def inner(v: object) -> object:
    """What an object or array wraps: its first text, else itself."""
    if isinstance(v, (dict, list)):
        for x in v.values() if isinstance(v, dict) else v:
            if type(x) is str and x:
                return x
    return v


def same_data(kind: str | None, text: str) -> str:
    """A value in one notation, so that it can be recognised under another type or key.

    An object or array, given as JSON, is what it wraps.  Days are ISO; amounts keep four significant digits, as they are also printed rounded, in millions; the
    rest is lower case.
    """
    if kind in ("object", "array"):
        text = text_of(inner(json.loads(text, parse_int=_Literal, parse_float=_Literal)))
    if m := _ISO.match(text):
        return m[1]
    if m := _DMY.match(text):
        return f"{m[3]}-{m[2]}-{m[1]}"
    if _EPOCH.match(text):
        return (date(1970, 1, 1) + timedelta(days=int(text) // 86_400_000)).isoformat()
    if (m := _AMOUNT.match(text)) and (m[2] or "." in m[1] or "," in m[1]):
        n = float(m[1].replace(",", "")) * (1e6 if m[2] else 1)
        return f"#{n:.3e}"
    return text.strip().lower()


def file_order(files: DataFrame) -> DataFrame:
    """(file_id, prev_file, next_file): the neighbours in the same feed by ``as_of``, ties by ``file_id``.

    A repeated file counts once, a file without a feed has no neighbours.  One row per file, so a feed is ordered
    in one task whatever the number of its lines.
    """
    one = files.where("file_id IS NOT NULL").groupBy("file_id").agg(F.min(F.struct("feed_id", "as_of")).alias("f")).select("file_id", "f.*")
    w = W.partitionBy("feed_id").orderBy("as_of", "file_id")
    fed = F.col("feed_id").isNotNull()
    return one.select("file_id", F.when(fed, F.lag("file_id").over(w)).alias("prev_file"), F.when(fed, F.lead("file_id").over(w)).alias("next_file"))


def field_types(rows: DataFrame) -> DataFrame:
    """(file_id, field, json_type, n_values): the type of a field's non-null values in a file; several are joined by '|'.

    Fields and types are counted inside each batch, so that what leaves a task is a row per file, field and type.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: Counter = Counter()
            for file, payload in zip(b["file_id"].tolist(), b["payload"].tolist(), strict=True):
                for key, v in (path_values(payload) or {}).items():
                    seen[file, key, json_type(v)] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["file_id", "field", "json_type", "n"])

    counted = rows.select("file_id", "payload").mapInPandas(count, "file_id string, field string, json_type string, n long")
    return counted.groupBy("file_id", "field").agg(
        F.array_join(F.array_sort(F.collect_set("json_type")), "|").alias("json_type"), F.coalesce(F.sum(F.when(F.col("json_type").isNotNull(), F.col("n"))), F.lit(0)).alias("n_values")
    )


def _differing(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(file_id, prev_file, field, t0, t1): fields that went (t1 null), came (t0 null) or have another type."""
    types = field_types(rows).join(file_order(files), "file_id")
    none = F.lit(None).cast("string")
    now = F.when(F.col("prev_file").isNotNull(), F.struct(F.col("file_id").alias("at"), F.col("prev_file").alias("prev_file"), none.alias("t0"), F.col("json_type").alias("t1")))
    then = F.when(F.col("next_file").isNotNull(), F.struct(F.col("next_file").alias("at"), F.col("file_id").alias("prev_file"), F.col("json_type").alias("t0"), none.alias("t1")))
    both = (
        types.select("field", F.explode(F.array_compact(F.array(now, then))).alias("s"))
        .groupBy(F.col("s.at").alias("file_id"), F.col("s.prev_file").alias("prev_file"), "field")
        .agg(F.max("s.t0").alias("t0"), F.max("s.t1").alias("t1"))
    )
    return both.where("t0 IS NULL OR t1 IS NULL OR (t0 <> t1 AND t0 <> '' AND t1 <> '')")


def _shared_values(rows: DataFrame, differing: DataFrame) -> DataFrame:
    """(file_id, old_field, new_field, n): values that a field that went and one that came have in common.

    With either field null, the number of the other's values.  Lines are parsed again where they lie, for the
    fields asked of their file; equal values are counted inside each batch.
    """
    asked = differing.groupBy("file_id", "prev_file").agg(F.collect_list(F.when(F.col("t1").isNull(), F.col("field"))).alias("went"), F.collect_list(F.when(F.col("t0").isNull(), F.col("field"))).alias("came"))
    asked = asked.where("size(went) > 0 AND size(came) > 0")
    of_old = F.struct(F.col("prev_file").alias("source"), F.col("file_id").alias("target"), F.lit(True).alias("old"), F.col("went").alias("fields"))
    of_new = F.struct(F.col("file_id").alias("source"), F.col("file_id").alias("target"), F.lit(False).alias("old"), F.col("came").alias("fields"))
    # at most two entries a file: as the newer and as the older one
    asked = materialize(
        asked.select(F.explode(F.array(of_old, of_new)).alias("s")).select("s.*").groupBy(F.col("source").alias("file_id")).agg(F.to_json(F.collect_list(F.struct("target", "old", "fields"))).alias("asked"))
    )
    if asked.count() <= BROADCAST_FILES:
        asked = F.broadcast(asked)

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tasks: dict[str, list[dict]] = {}
        for b in batches:
            seen: Counter = Counter()
            for task, payload in zip(b["asked"].tolist(), b["payload"].tolist(), strict=True):
                obj = path_values(payload, _Literal)
                if obj is None:
                    continue
                if task not in tasks:
                    tasks[task] = json.loads(task)
                for t in tasks[task]:
                    for field in t["fields"]:
                        text = text_of(inner(obj.get(field)))
                        if text is not None:
                            v = same_data(None, text)
                            seen[t["target"], t["old"], field, v if len(v) <= LONGEST else blake2b(v.encode("utf-8", "surrogatepass"), digest_size=24).hexdigest()] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["file_id", "old", "field", "value", "n"])

    counted = rows.select("file_id", "payload").join(asked, "file_id").select("asked", "payload").mapInPandas(values, "file_id string, old boolean, field string, value string, n long")
    # one shuffle by file and value; a value's entries are as many as the fields that went or came
    held = counted.repartition("file_id", "value").groupBy("file_id", "value", "old", "field").agg(F.sum("n").alias("n"))
    held = held.groupBy("file_id", "value").agg(F.collect_list(F.struct("old", "field", "n")).alias("e"))
    none = F.lit(None).cast("string")
    pair = lambda old, new, n: F.struct(old.alias("old_field"), new.alias("new_field"), n.alias("n"))
    alone = F.transform("e", lambda x: pair(F.when(x["old"], x["field"]), F.when(~x["old"], x["field"]), x["n"]))
    common = F.flatten(
        F.transform(F.filter("e", lambda x: x["old"]), lambda x: F.transform(F.filter("e", lambda y: ~y["old"]), lambda y: pair(x["field"], y["field"], F.least(x["n"], y["n"]))))
    )
    fields = differing.where("t0 IS NULL OR t1 IS NULL").select(
        "file_id", F.when(F.col("t1").isNull(), F.col("field")).otherwise(none).alias("old_field"), F.when(F.col("t0").isNull(), F.col("field")).otherwise(none).alias("new_field"), F.lit(0).cast("long").alias("n")
    )
    counts = held.select("file_id", F.explode(F.concat(alone, common)).alias("c")).select("file_id", "c.*").unionByName(fields)
    return counts.groupBy("file_id", "old_field", "new_field").agg(F.sum("n").alias("n"))


def changes(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(file_id, change_kind, old_field, new_field) of each file against the one before it in its feed.

    ``added`` and ``removed`` leave the other field empty; ``renamed`` pairs a field that went with one that
    came and holds the same data; ``retyped`` gives the field twice.  A field all null in either file isn't
    retyped.  A file without readable lines has no fields: everything is removed there and added again after.
    Lines of unlisted files are ignored; repeated lines and files change nothing; empty tables give no rows.
    """
    rows = rows.select("file_id", "payload")
    differing = materialize(_differing(rows, files))  # a few rows a file
    retyped = differing.where("t0 IS NOT NULL AND t1 IS NOT NULL").select("file_id", F.lit("retyped").alias("change_kind"), F.col("field").alias("old_field"), F.col("field").alias("new_field"))
    counts = _shared_values(rows, differing).repartition("file_id")  # all that follows is inside a file's few fields
    old, new = W.partitionBy("file_id", "old_field"), W.partitionBy("file_id", "new_field")
    pair = F.col("old_field").isNotNull() & F.col("new_field").isNotNull()
    sized = counts.withColumn("s0", F.max(F.when(F.col("new_field").isNull(), F.col("n"))).over(old)).withColumn("s1", F.max(F.when(F.col("old_field").isNull(), F.col("n"))).over(new))
    share = F.when(pair, F.col("n") / F.least("s0", "s1"))
    sized = sized.withColumn("share", F.when(share >= RENAME_OVERLAP, share))
    # a pair stands if each is the other's best
    rank = [F.desc_nulls_last("share"), F.desc("n"), "old_field", "new_field"]
    best = sized.withColumn("__a", F.row_number().over(old.orderBy(*rank))).withColumn("__b", F.row_number().over(new.orderBy(*rank)))
    best = best.withColumn("__won", (F.col("share").isNotNull() & (F.col("__a") == 1) & (F.col("__b") == 1)).cast("int"))
    best = best.withColumn("__old", F.max("__won").over(old)).withColumn("__new", F.max("__won").over(new))
    kind = F.when(pair, F.when(F.col("__won") == 1, "renamed")).when(F.col("new_field").isNull(), F.when(F.col("__old") == 0, "removed")).otherwise(F.when(F.col("__new") == 0, "added"))
    found = best.select("file_id", kind.alias("change_kind"), F.coalesce("old_field", F.lit("")).alias("old_field"), F.coalesce("new_field", F.lit("")).alias("new_field")).where("change_kind IS NOT NULL")
    return found.unionByName(retyped)


def _key(name: str) -> str:
    return "".join(ch for ch in name.lower() if "a" <= ch <= "z" or "0" <= ch <= "9")


def learned_names(renames: DataFrame, files: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """(feed_id, names json): fields of each feed that go by no known name, with the target that renames lead to.

    Names joined by renames are one field; if exactly one target is known among them, it is that of all.  The
    distinct renames of a feed are as few as its spellings.
    """
    known = {_key(a): target for target, names in fields.items() for a in names}
    edges = renames.where("change_kind = 'renamed'").join(files.select("file_id", "feed_id").distinct(), "file_id").groupBy("feed_id").agg(F.to_json(F.collect_set(F.struct("old_field", "new_field"))).alias("edges"))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for feed, pairs in zip(b["feed_id"].tolist(), b["edges"].tolist(), strict=True):
                group: dict[str, str] = {}

                def root(x: str, group: dict[str, str] = group) -> str:
                    while group.setdefault(x, x) != x:
                        x = group[x]
                    return x

                for p in json.loads(pairs):
                    group[root(p["old_field"])] = root(p["new_field"])
                targets: dict[str, set[str]] = {}
                for name in group:
                    if _key(name) in known:
                        targets.setdefault(root(name), set()).add(known[_key(name)])
                got = {n: next(iter(t)) for n in sorted(group) if _key(n) not in known and len(t := targets.get(root(n), set())) == 1}
                if got:
                    out.append((feed, json.dumps(got, ensure_ascii=False)))
            yield pd.DataFrame(out, columns=["feed_id", "names"])

    return edges.mapInPandas(learn, "feed_id long, names string")


def consistent_table(rows: DataFrame, files: DataFrame, fields: dict[str, list[str]] | None = None) -> DataFrame:
    """All readable lines as one typed table, a row per line.

    A target field takes the first value that is not null among the keys that go by one of its names, in their
    order, then among the keys that renames in the feed lead from such a name (in order of the key).  Dates are
    DATE, amounts DECIMAL(22,4), the rest text.  ``failed_casts`` lists the fields whose value could not be cast
    (and is null), ``other_fields`` keeps the keys that belong to no target as JSON.  Repeated lines stay;
    lines of unlisted files have a null bank and day; empty tables give no rows.
    """
    fields = fields or FIELD_NAMES
    order = {_key(a): (target, k) for target, names in reversed(fields.items()) for k, a in reversed(list(enumerate(names)))}
    targets = list(fields)
    learned = learned_names(changes(rows, files), files, fields)
    listed = files.where("file_id IS NOT NULL").groupBy("file_id").agg(F.min(F.struct("feed_id", "bank_id", "as_of")).alias("f")).select("file_id", "f.*").join(learned, "feed_id", "left").drop("feed_id")
    keep = ["raw_id", "file_id", "bank_id", "as_of", "line_no"]

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learnt: dict[str | None, dict[str, str]] = {None: {}}
        for b in batches:
            made, lines = [], []
            for k, (payload, names) in enumerate(zip(b["payload"].tolist(), b["names"].tolist(), strict=True)):
                obj = path_values(payload, _Literal)
                if obj is None:
                    continue
                if names not in learnt:
                    learnt[names] = json.loads(names)
                best: dict[str, tuple] = {}
                other = {}
                for key in sorted(obj):
                    target, place = order.get(_key(key)) or (learnt[names].get(key), len(order))
                    text = text_of(inner(obj[key])) if target else text_of(obj[key])
                    if target is None:
                        other[key] = text or ""
                    elif text is not None and (target not in best or place < best[target][0]):
                        best[target] = (place, text)
                made.append((*(best[t][1] if t in best else None for t in targets), json.dumps(other, ensure_ascii=False)))
                lines.append(k)
            left = b[keep].iloc[lines].reset_index(drop=True)
            yield pd.concat([left, pd.DataFrame(made, columns=[*targets, "other_fields"], dtype=object)], axis=1)

    types = "raw_id long, file_id string, bank_id string, as_of string, line_no int"
    lines = rows.select("raw_id", "file_id", F.col("line_no").cast("int").alias("line_no"), "payload").join(listed, "file_id", "left")
    raw = lines.mapInPandas(project, f"{types}, {', '.join(f'`{t}` string' for t in targets)}, other_fields string")
    out, failed = [], []
    for name in targets:
        c = F.col(f"`{name}`")
        kind = FIELD_KINDS.get(name, "text")
        typed = {"date": _day(c).try_cast("date"), "amount": _number(c).cast("decimal(22,4)")}.get(kind, c)
        out.append(typed.alias(name))
        failed.append(F.when(c.isNotNull() & typed.isNull(), F.lit(name)))
    return raw.select(*keep, *out, F.array_compact(F.array(*failed)).alias("failed_casts"), "other_fields")
