"""Transforms: rows with picks in, posts out. Register more with ``register_transform``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import picks, strict_json, text
from ..functions.cleaners import apply_cleaners
from ..operators.completion import CallPolicy, Client, complete
from ..schemas import POST_FIELDS
from . import prompts


def author_pool(cfg: dict) -> list[str]:
    """The transform's author pool, or else the load side's."""
    for part in ("transform", "load"):
        pool = ((cfg.get(part) or {}).get("author") or {}).get("pool")
        if pool:
            return list(pool)
    return []


def labels_of(transform: dict) -> list[str]:
    return list((transform.get("category") or {}).get("labels") or [])


def with_picks(df: DataFrame, cfg: dict) -> DataFrame:
    """Add the per-row author, date and fallback category."""
    transform = cfg.get("transform") or {}
    seed = int((cfg.get("dataset") or {}).get("seed", 42))
    dates, labels = transform.get("date") or {}, labels_of(transform)
    id_ = F.col("source_id")
    date = F.lit("")
    if dates:
        date = picks.pick_date(id_, dates["range_start"], dates["range_end"], seed)
    return df.select(
        "*",
        picks.pick_author(id_, author_pool(cfg), seed).alias("author"),
        date.alias("date_gmt"),
        F.lit(labels[0] if labels else "").alias("category_fallback"),
    )


def _field(df: DataFrame, name: str | None) -> Column:
    return text.or_empty(F.col(f"`{name}`")) if name and name in df.columns else F.lit("")


#: What a completion reports besides its text.
CALL_COLUMNS = ("error", "input_tokens", "output_tokens", "retries", "rate_limited")


@dataclass
class Completing:
    """What the synth transform calls: ``make_client(schema)`` builds a client on an
    executor; ``schema`` is the response schema, or None when not ``structured``.
    ``partitions`` bounds how many tasks call at once (each ``policy.concurrency``
    wide), for endpoints that limit their callers. Results are committed every
    ``slice_rows`` rows, so a run that dies pays again for open tasks at most."""

    make_client: Callable[[dict | None], Client]
    model: str = ""
    structured: bool = False
    partitions: int | None = None
    slice_rows: int = 100_000
    policy: CallPolicy = field(default_factory=CallPolicy)


@dataclass
class Passthrough:
    """Rows that already carry title, body and maybe category."""

    title_field: str = "title"
    body_field: str = "body"
    category_field: str | None = None
    identity: str = ""

    def signature(self) -> str:
        return prompts.signature(
            type="passthrough",
            fields=[self.title_field, self.body_field, self.category_field],
            source=self.identity,
        )

    def posts(self, df: DataFrame) -> DataFrame:
        title = text.or_else(text.py_strip(_field(df, self.title_field)), F.lit(text.UNTITLED))
        category = text.py_strip(_field(df, self.category_field))
        made = {
            "title": title,
            "content": _field(df, self.body_field),
            "category": text.or_else(category, F.col("category_fallback")),
        }
        return _post_columns(df, made).withColumn("error", F.lit(None).cast("string"))


@dataclass
class Synth:
    """Title, category and date from a completion over the cleaned body."""

    completing: Completing
    labels: list[str]
    range_start: str
    range_end: str
    body_field: str = "body"
    summary_field: str = "summary"
    title_limit: int = 80
    prompt_chars: int = prompts.PROMPT_CHARS
    cleaners: list[dict] = field(default_factory=list)
    template: str | None = None
    seed: int = 42
    identity: str = ""

    def __post_init__(self) -> None:
        if not self.labels:
            raise ValueError("labels must not be empty")

    def signature(self) -> str:
        return prompts.signature(
            type="synth",
            source=self.identity,
            model=self.completing.model,
            template=self.template or prompts.DEFAULT_TEMPLATE,
            labels=self.labels,
            cleaners=self.cleaners,
            dates=[self.range_start, self.range_end],
            max_tokens=self.completing.policy.max_tokens,
            title_limit=self.title_limit,
            prompt_chars=self.prompt_chars,
            fields=[self.body_field, self.summary_field],
            seed=self.seed,
        )

    @property
    def slice_rows(self) -> int:
        return self.completing.slice_rows

    def posts(self, df: DataFrame) -> DataFrame:
        calls = self.completing
        system = prompts.system_prompt(self.template, self.labels, self.range_start, self.range_end)
        schema = prompts.response_schema(self.labels) if calls.structured else None
        if calls.partitions:
            # by content too, so that rows sharing an id don't share a task
            df = df.repartition(calls.partitions, "source_id", self.body_field if self.body_field in df.columns else "source_id")
        cleaned = df.withColumn(
            "_body", text.py_strip(apply_cleaners(_field(df, self.body_field), self.cleaners))
        )
        answered = cleaned.withColumn(
            "_call",
            complete(
                prompts.user_message(F.col("_body"), self.prompt_chars),
                system,
                partial(calls.make_client, schema),
                calls.policy,
            ),
        ).select(
            "*",
            F.col("_call.raw").alias("raw_output"),
            *[F.col(f"_call.{name}").alias(name) for name in CALL_COLUMNS],
        )
        kept = answered.withColumnRenamed("_body", "cleaned_body").drop("_call")
        return self.from_output(kept, "raw_output", F.col("cleaned_body"), CALL_COLUMNS)

    def from_output(
        self, df: DataFrame, raw: str, body: Column, keep: tuple[str, ...] = ()
    ) -> DataFrame:
        """Posts from raw model output, with a fallback for everything missing in it."""
        read = strict_json.parse_output(df, raw, self.labels, self.title_limit)
        parsed, id_ = F.col("parsed"), F.col("source_id")
        summary = text.title_from_summary(_field(df, self.summary_field), self.title_limit)
        fallback = text.or_else(F.col("category_fallback"), F.lit(self.labels[0]))
        date = picks.date_from_year_month(
            parsed.date_ym, id_, self.range_start, self.range_end, self.seed
        )
        made = {
            "title": text.or_else(parsed.title, summary),
            "content": body,
            "category": text.or_else(parsed.category, fallback),
            "date_gmt": F.coalesce(date, F.col("date_gmt")),
        }
        return _post_columns(read, made, keep)


def _post_columns(df: DataFrame, made: dict[str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    fields = [(made[f] if f in made else F.col(f)).alias(f) for f in POST_FIELDS]
    return df.select(*fields, *keep)


def _build_passthrough(transform: dict, cfg: dict, completing: Completing | None) -> Passthrough:
    return Passthrough(
        transform.get("title_field", "title"),
        transform.get("body_field", "body"),
        transform.get("category_field"),
        prompts.source_identity(cfg.get("source") or {}),
    )


def _build_synth(transform: dict, cfg: dict, completing: Completing | None) -> Synth:
    if completing is None:
        raise ValueError("transform type 'synth' needs a completion client")
    completing.policy.max_tokens = int(
        transform.get("max_tokens_combined", completing.policy.max_tokens)
    )
    dates = transform["date"]
    return Synth(
        completing=completing,
        labels=labels_of(transform),
        range_start=dates["range_start"],
        range_end=dates["range_end"],
        body_field=transform.get("body_field", "body"),
        summary_field=transform.get("summary_field", "summary"),
        title_limit=int((transform.get("title") or {}).get("max_length", 80)),
        prompt_chars=int(transform.get("prompt_chars", prompts.PROMPT_CHARS)),
        cleaners=list(transform.get("cleaners") or []),
        template=transform.get("prompt_template"),
        seed=int((cfg.get("dataset") or {}).get("seed", 42)),
        identity=prompts.source_identity(cfg.get("source") or {}),
    )


TRANSFORMS: dict[str, Callable] = {"passthrough": _build_passthrough, "synth": _build_synth}


def register_transform(name: str, build: Callable) -> None:
    """``build(transform_cfg, cfg, completing)`` returns an object with
    ``signature() -> str`` and ``posts(df) -> df`` (the post fields plus ``error``)."""
    TRANSFORMS[name] = build


def build_transform(cfg: dict, completing: Completing | None = None):
    transform = cfg.get("transform") or {}
    kind = transform.get("type")
    if kind not in TRANSFORMS:
        known = ", ".join(sorted(TRANSFORMS))
        raise ValueError(f"unknown transform type {kind!r}; known: {known}")
    return TRANSFORMS[kind](transform, cfg, completing)
