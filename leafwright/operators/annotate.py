"""Annotation of paragraphs by a callable: units, cache keys, cache probe, batches, calls, validation, merge, records.

The callable gets a batch's prompt and returns the response as JSON text; there is no
network here. Every stage is a table, so a run can be looked at between any two.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.vocabulary import CERTAINTY, NO_STANCE_ROLES, PARAGRAPH_SECTIONS, PRICES, ROLES, SENTENCE_SECTIONS, SOURCE_HEDGE, SUMMARY_HEDGE

SENTENCES = "array<struct<sentence_id:string,start:int,end:int>>"
STATS = "array<struct<metric:string,value:double,unit:string,p:double,n:double,comparison:string,start:int,end:int>>"
SPANS = "array<struct<start:int,end:int>>"
RESULT = f"role string, gist string, plain string, sentences array<struct<certainty:string,hedges:{SPANS},stats:{STATS},sentence_id:string>>"
_RESULT_FIELDS = ("role", "gist", "plain", "sentences")


@dataclass(frozen=True)
class Pass:
    """A kind of annotation."""

    name: str
    prompt_version: str
    sections: tuple[str, ...]
    batch: int
    closing: str
    parse: Callable[[object, list[dict]], tuple[dict[str, dict], list[str]]]


def cache_key(model: str, prompt_version: str, text: Column, sentences: Column) -> Column:
    """First 32 hex digits of the SHA-256 of the compact JSON of model, version, text and sentence spans; ids are not in it."""
    spans = F.transform(sentences, lambda s: F.array(s["start"], s["end"]))
    body = F.to_json(F.struct(F.lit(model).alias("model"), F.lit(prompt_version).alias("promptVersion"), text.alias("text"), spans.alias("sentences")))
    return F.substring(F.sha2(body, 256), 1, 32)


def units(paragraphs: DataFrame, kind: Pass, model: str, sections: tuple[str, ...] | None = None) -> DataFrame:
    """Paragraphs of the covered sections with a sentence at least, each with its cache key."""
    held = paragraphs.where(F.col("section_type").isin(*(sections or kind.sections)) & (F.size("sentences") > 0))
    key = cache_key(model, kind.prompt_version, F.col("text"), F.col("sentences"))
    return held.select("article_id", "paragraph_id", "ord", "section_type", "section_title", "text", F.col("sentences").cast(SENTENCES).alias("sentences"), key.alias("cache_key"))


def _usable(kind: Pass) -> Column:
    """Whether a stored result still fits: known role and texts, or as many sentences as the unit has."""
    if kind.name == "paragraph":
        return F.col("cached.role").isin(*ROLES) & F.col("cached.gist").isNotNull() & F.col("cached.plain").isNotNull()
    return F.size("cached.sentences") == F.size("sentences")


def probed(found: DataFrame, cache: DataFrame, kind: Pass, force: bool = False) -> DataFrame:
    """Units with ``cached``: the stored result, or null on a miss, an unusable entry or if forced."""
    stored = cache.where((F.col("pass") == kind.name) & F.lit(not force)).select("cache_key", F.struct(*_RESULT_FIELDS).alias("cached")).dropDuplicates(["cache_key"])
    joined = found.join(stored, "cache_key", "left")
    ids = F.zip_with("cached.sentences", "sentences", lambda c, s: c.withField("sentence_id", s["sentence_id"]))
    restored = F.col("cached") if kind.name == "paragraph" else F.col("cached").withField("sentences", ids)
    return joined.withColumn("cached", F.when(_usable(kind), restored))


def batched(misses: DataFrame, limit: int, max_requests: int | None = None, size: Column | None = None, group: str = "article_id") -> DataFrame:
    """Adds ``batch``: greedy packing in document order within a group; a unit is never split, one over the limit stands alone.

    The sum starts over with each batch, so it is a fold over the group's sizes, not a window frame.
    """
    weight = F.size("sentences") if size is None else size
    listed = misses.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("ord", "paragraph_id", weight.cast("long").alias("n")))).alias("members"))
    start = F.struct(F.lit(0).cast("long").alias("batch"), F.lit(0).cast("long").alias("n"), F.array().cast("array<long>").alias("out"))

    def step(acc: Column, u: Column) -> Column:
        over = (acc["n"] > 0) & (acc["n"] + u["n"] > limit)
        batch = acc["batch"] + over.cast("long")
        return F.struct(batch.alias("batch"), F.when(over, u["n"]).otherwise(acc["n"] + u["n"]).alias("n"), F.array_append(acc["out"], batch).alias("out"))

    numbers = F.aggregate("members", start, step, lambda acc: acc["out"])
    placed = listed.select(group, F.explode(F.arrays_zip(F.col("members.paragraph_id").alias("paragraph_id"), numbers.alias("batch"))).alias("x")).select(group, "x.paragraph_id", "x.batch")
    if max_requests is not None:
        placed = placed.where(F.col("batch") < max_requests)
    return misses.join(placed, [group, "paragraph_id"])


def _heading(u: dict) -> str:
    return " ".join(filter(None, (u["section_title"], f"({u['section_type']})")))


def prompt(kind: Pass, batch: list[dict]) -> str:
    out = []
    for u in batch:
        if kind.name == "paragraph":
            out += [f"## [{u['paragraph_id']}] {_heading(u)}", u["text"], ""]
        else:
            listed = [f"[{s['sentence_id']}] {u['text'][s['start'] : s['end']]}" for s in u["sentences"]]
            out += [f"## Paragraph {u['paragraph_id']} — {_heading(u)}", "", "Full paragraph (context):", u["text"], "", "Sentences to classify:", *listed, ""]
    return "\n".join([*out, kind.closing])


def parse_paragraphs(raw: object, batch: list[dict]) -> tuple[dict[str, dict], list[str]]:
    """Valid rows of a paragraph response by id, and what was wrong; an invalid row does not stand in a later one's way."""
    known = {u["paragraph_id"] for u in batch}
    rows = raw.get("paragraphs") if isinstance(raw, dict) else None
    if not isinstance(rows, list):
        return {}, ["response without paragraphs"]
    found: dict[str, dict] = {}
    warnings = []
    for row in rows:
        row = row if isinstance(row, dict) else {}
        key = row.get("id") if isinstance(row.get("id"), str) else ""
        text = {k: row[k].strip() if isinstance(row.get(k), str) else "" for k in ("gist", "plain")}
        if key not in known:
            warnings.append(f"unknown paragraph: {key!r}")
        elif key in found:
            warnings.append(f"{key}: repeated")
        elif row.get("role") not in ROLES:
            warnings.append(f"{key}: unknown role {row.get('role')!r}")
        elif not text["gist"] or not text["plain"]:
            warnings.append(f"{key}: empty gist or plain")
        else:
            found[key] = {"role": row["role"], **text, "sentences": None, "complete": True}
    return found, warnings + [f"{u['paragraph_id']}: no summary" for u in batch if u["paragraph_id"] not in found]


def quote_span(text: str, start: int, end: int, quote: str) -> tuple[int, int] | None:
    """Where a quote stands in a sentence, verbatim."""
    bare = quote.strip()
    at = text.find(bare, start) if bare else -1
    return (at, at + len(bare)) if 0 <= at and at + len(bare) <= end else None


def quote_span_column(text: Column, start: Column, end: Column, quote: Column) -> Column:
    """quote_span() as a column: a struct of start and end, null where the quote doesn't stand in the sentence."""
    bare = F.regexp_replace(quote, r"^\s+|\s+$", "")
    at = F.position(bare, text, start + 1)
    return F.when((bare != "") & (at > 0) & (at - 1 + F.length(bare) <= end), F.struct((at - 1).alias("start"), (at - 1 + F.length(bare)).alias("end")))


def _number(value: object) -> float | None:
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) and abs(value) < float("inf") else None


def _word(value: object) -> str | None:
    return value if isinstance(value, str) and value else None


def parse_sentences(raw: object, batch: list[dict]) -> tuple[dict[str, dict], list[str]]:
    """Valid rows of a sentence response by paragraph; quotes that are not in their sentence are dropped. A row's id is taken even if the row is invalid."""
    where = {s["sentence_id"]: (u, s) for u in batch for s in u["sentences"]}
    rows = raw.get("sentences") if isinstance(raw, dict) else None
    if not isinstance(rows, list):
        return {}, ["response without sentences"]
    found: dict[str, list[dict]] = {}
    warnings, seen = [], set()
    for row in rows:
        row = row if isinstance(row, dict) else {}
        key = row.get("id") if isinstance(row.get("id"), str) else ""
        if key not in where:
            warnings.append(f"unknown sentence: {key!r}")
            continue
        if key in seen:
            warnings.append(f"{key}: repeated")
            continue
        seen.add(key)
        if row.get("certainty") not in CERTAINTY:
            warnings.append(f"{key}: unknown certainty {row.get('certainty')!r}")
            continue
        unit, sentence = where[key]
        locate = lambda q: quote_span(unit["text"], sentence["start"], sentence["end"], q)  # noqa: B023, E731
        hedges, stats = [], []
        for q in row["hedges"] if isinstance(row.get("hedges"), list) else []:
            if isinstance(q, str):
                if span := locate(q):
                    hedges.append({"start": span[0], "end": span[1]})
                else:
                    warnings.append(f"{key}: hedge not in the text {q!r}")
        for s in row["stats"] if isinstance(row.get("stats"), list) else []:
            s = s if isinstance(s, dict) else {}
            quote = s.get("quote") if isinstance(s.get("quote"), str) else ""
            if span := locate(quote):
                stats.append({k: _word(s.get(k)) for k in ("metric", "unit", "comparison")} | {k: _number(s.get(k)) for k in ("value", "p", "n")} | {"start": span[0], "end": span[1]})
            else:
                warnings.append(f"{key}: stat not in the text {quote!r}")
        found.setdefault(unit["paragraph_id"], []).append({"sentence_id": key, "certainty": row["certainty"], "hedges": hedges, "stats": stats})
    for u in batch:
        n = len(found.get(u["paragraph_id"], []))
        if n != len(u["sentences"]):
            warnings.append(f"{u['paragraph_id']}: {n} of {len(u['sentences'])} sentences")
    full = {u["paragraph_id"]: len(u["sentences"]) for u in batch}
    return {k: {"role": None, "gist": None, "plain": None, "sentences": v, "complete": len(v) == full[k]} for k, v in found.items()}, warnings


PARAGRAPH = Pass("paragraph", "paragraph-1", PARAGRAPH_SECTIONS, 60, "Summarize every paragraph above. Return one entry per paragraph id, in the same order.", parse_paragraphs)
SENTENCE = Pass("sentence", "sentence-1", SENTENCE_SECTIONS, 25, "Classify every sentence listed above. Return one entry per sentence id, in the same order.", parse_sentences)
PASSES = {p.name: p for p in (PARAGRAPH, SENTENCE)}
Caller = Callable[[str, list[dict]], str]


def stub_caller(kind: Pass) -> Caller:
    """A deterministic stand-in: the first words as summary, every sentence supported."""

    def call(_: str, batch: list[dict]) -> str:
        if kind.name == "paragraph":
            return json.dumps({"paragraphs": [{"id": u["paragraph_id"], "role": "other", "gist": u["text"][:40] or "-", "plain": u["text"][:120] or "-"} for u in batch]})
        return json.dumps({"sentences": [{"id": s["sentence_id"], "certainty": "supported", "hedges": [], "stats": []} for u in batch for s in u["sentences"]]})

    return call


def called(batches: DataFrame, kind: Pass, caller: Caller | None = None) -> DataFrame:
    """(article_id, paragraph_id, complete, warnings, result fields) of every unit in a batch; a batch's own warnings stand with its first unit.

    A batch is a group of at most ``kind.batch`` sentences. A call that fails leaves its batch without results.
    """
    ask = caller or stub_caller(kind)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ord")
        batch = [{**u, "sentences": [dict(zip(("sentence_id", "start", "end"), (s["sentence_id"], s["start"], s["end"]), strict=True)) for s in u["sentences"]]} for u in frame.to_dict("records")]
        try:
            found, warnings = kind.parse(json.loads(ask(prompt(kind, batch), batch)), batch)
        except Exception as e:  # noqa: BLE001 - whatever the caller does, the other batches go on
            found, warnings = {}, [f"call failed: {e}"]
        rows = []
        for k, u in enumerate(batch):
            got = found.get(u["paragraph_id"])
            rows.append({"article_id": u["article_id"], "paragraph_id": u["paragraph_id"], "cache_key": u["cache_key"], "answered": got is not None, "complete": bool(got and got["complete"]), "warnings": warnings if k == 0 else [], **{f: got[f] if got else None for f in _RESULT_FIELDS}})
        return pd.DataFrame(rows)

    schema = f"article_id string, paragraph_id string, cache_key string, answered boolean, complete boolean, warnings array<string>, {RESULT}"
    return batches.groupBy("article_id", "batch").applyInPandas(run, schema)


def cache_entries(answers: DataFrame, kind: Pass) -> DataFrame:
    """Rows to append to the cache: complete answers only; sentence ids are left out, as they depend on the place."""
    bare = F.transform("sentences", lambda s: s.withField("sentence_id", F.lit(None).cast("string")))
    return answers.where("complete").select(F.lit(kind.name).alias("pass"), "cache_key", "role", "gist", "plain", bare.alias("sentences")).dropDuplicates(["pass", "cache_key"])


def hedge_lost(role: Column, text: Column, plain: Column) -> Column:
    """A source that hedges with a summary that does not, outside descriptions of procedure."""
    return ~role.isin(*NO_STANCE_ROLES) & text.rlike(SOURCE_HEDGE) & ~plain.rlike(SUMMARY_HEDGE)


def merged(paragraphs: DataFrame, results: DataFrame) -> DataFrame:
    """Paragraphs with role, gist, plain and annotated sentences where there is a result, and the merge's warnings.

    A sentence keeps only spans inside itself; nothing left means null, not an empty array.
    """
    given = results.select("article_id", "paragraph_id", F.struct(*_RESULT_FIELDS).alias("r"))
    joined = paragraphs.join(given, ["article_id", "paragraph_id"], "left")

    def annotated(s: Column) -> Column:
        own = F.filter("r.sentences", lambda x: x["sentence_id"] == s["sentence_id"])
        got = F.try_element_at(own, F.lit(1))
        inside = lambda x: (x["start"] >= s["start"]) & (x["end"] <= s["end"]) & (x["start"] < x["end"])
        hedges, stats = F.filter(got["hedges"], inside), F.filter(got["stats"], inside)
        return F.struct(
            s["sentence_id"].alias("sentence_id"), s["start"].alias("start"), s["end"].alias("end"), got["certainty"].alias("certainty"),
            F.when(F.size(hedges) > 0, hedges).alias("hedges"), F.when(F.size(stats) > 0, stats).alias("stats"),
        )

    lost = F.when(F.coalesce(hedge_lost(F.col("r.role"), F.col("text"), F.col("r.plain")), F.lit(False)), F.array(F.concat("paragraph_id", F.lit(": source hedges, summary does not"))))
    return joined.select(
        *[c for c in paragraphs.columns if c not in ("role", "gist", "plain", "sentences")],
        F.col("r.role").alias("role"), F.col("r.gist").alias("gist"), F.col("r.plain").alias("plain"),
        F.transform("sentences", annotated).alias("sentences"), F.col("r").isNotNull().alias("applied"), F.coalesce(lost, F.array().cast("array<string>")).alias("merge_warnings"),
    )


@dataclass
class Run:
    """What one pass over a corpus made."""

    paragraphs: DataFrame
    cache: DataFrame
    record: DataFrame


def annotate(paragraphs: DataFrame, cache: DataFrame, kind: Pass, model: str, caller: Caller | None = None, force: bool = False, max_requests: int | None = None, sections: tuple[str, ...] | None = None, batch: int | None = None) -> Run:
    """Units, cache probe, batches of the misses, calls, cache entries, merge and the run's record by article."""
    looked = probed(units(paragraphs, kind, model, sections), cache, kind, force)
    hits = looked.where("cached IS NOT NULL").select("article_id", "paragraph_id", "cached.*")
    misses = looked.where("cached IS NULL").drop("cached")
    answers = called(batched(misses, batch or kind.batch, max_requests), kind, caller)
    results = hits.unionByName(answers.where("answered").select("article_id", "paragraph_id", *_RESULT_FIELDS))
    out = merged(paragraphs, results)
    per = out.groupBy("article_id").agg(F.count_if("applied").alias("applied"), F.flatten(F.collect_list("merge_warnings")).alias("merge_warnings"))
    counted = hits.groupBy("article_id").agg(F.count(F.lit(1)).alias("cached"))
    warned = answers.groupBy("article_id").agg(F.flatten(F.collect_list("warnings")).alias("call_warnings"))
    none = F.array().cast("array<string>")
    record = per.join(counted, "article_id", "left").join(warned, "article_id", "left").select(
        "article_id", F.lit(kind.name).alias("pass"), F.lit(model).alias("model"), F.lit(kind.prompt_version).alias("prompt_version"), "applied",
        F.coalesce("cached", F.lit(0)).alias("cached"), F.concat(F.coalesce("call_warnings", none), "merge_warnings").alias("warnings"),
    )
    return Run(out, cache.unionByName(cache_entries(answers, kind)), record)


def upserted(records: DataFrame, new: DataFrame) -> DataFrame:
    """Run records with the new ones in place of those of the same article and pass."""
    return records.join(new.select("article_id", "pass"), ["article_id", "pass"], "left_anti").unionByName(new)


def estimate(looked: DataFrame, kind: Pass) -> DataFrame:
    """Per article: units, sentences, cached units and requests that a run would make, without any call."""
    counts = looked.groupBy("article_id").agg(F.count(F.lit(1)).alias("n_units"), F.sum(F.size("sentences")).alias("n_sentences"), F.count("cached").alias("n_cached"))
    requests = batched(looked.where("cached IS NULL").drop("cached"), kind.batch).groupBy("article_id").agg((F.max("batch") + 1).alias("n_requests"))
    return counts.join(requests, "article_id", "left").na.fill(0, ["n_requests"])


def cost(usage: DataFrame) -> DataFrame:
    """Tokens and price by model tier of (model, input_tokens, output_tokens); no price for an unknown tier."""
    spark = usage.sparkSession
    prices = spark.createDataFrame([(k, *v) for k, v in PRICES.items()], "model string, price_in double, price_out double")
    total = usage.groupBy("model").agg(F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))
    return total.join(F.broadcast(prices), "model", "left").select("model", "input_tokens", "output_tokens", ((F.col("input_tokens") * F.col("price_in") + F.col("output_tokens") * F.col("price_out")) / 1e6).alias("cost"))


def stamped(rows: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows with ``saved_at``, the moment in UTC to the millisecond; ``at`` stands in for the clock."""
    moment = F.current_timestamp() if at is None else at
    return rows.withColumn("saved_at", F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def latest(cache: DataFrame) -> DataFrame:
    """One entry for each pass and key: the one saved last."""
    rest = [c for c in cache.columns if c not in ("pass", "cache_key")]
    newest = cache.groupBy("pass", "cache_key").agg(F.max_by(F.struct(*rest), F.col("saved_at")).alias("e"))
    return newest.select("pass", "cache_key", "e.*")
