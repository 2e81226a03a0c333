"""Keyword policies and relevance verdicts over tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import keyword_policy, mentions_any, prompt, verdict


@dataclass(frozen=True)
class Policy:
    """A relevance policy: who may pass, and what the classifier is told."""

    name: str
    description: str = ""
    include_terms: Sequence[str] = ()
    exclude_terms: Sequence[str] = ()


def keyword_filter(df: DataFrame, policy: Policy, content: str = "content") -> DataFrame:
    return df.where(keyword_policy(content, policy.include_terms, policy.exclude_terms))


def keyword_policies(df: DataFrame, policies: Sequence[Policy], content: str = "content") -> DataFrame:
    """One row per (record, accepting policy).

    Policies are parameters, so they become one array expression over each
    record: text is lower-cased once and nothing is joined or crossed.
    """
    if not policies:
        raise ValueError("at least one policy is needed")
    lowered = F.col("_lowered")
    accepted = F.array_compact(
        F.array(
            *[
                F.when(
                    ~mentions_any(lowered, p.exclude_terms) & mentions_any(lowered, p.include_terms), F.lit(p.name)
                )
                for p in policies
            ]
        )
    )
    keep = [c for c in df.columns if c != "policy"]
    text = F.lower(F.coalesce(F.col(content), F.lit("")))
    return df.withColumn("_lowered", text).select(*keep, F.explode(accepted).alias("policy"))


def relevance_gate(df: DataFrame, verdicts: DataFrame, key: str = "chunk_id", answer: str = "answer") -> DataFrame:
    """Keep records whose answer accepts them, and those without an answer (fail-open).

    A key may have several answers; one acceptance is enough.
    """
    judged = verdicts.groupBy(key).agg(F.max(verdict(answer)).alias("_accepted"))
    return df.join(judged, key, "left").where(F.coalesce("_accepted", F.lit(True))).drop("_accepted")


def score_relevance(
    df: DataFrame,
    scorer: Callable[[pd.Series], Sequence[str]],
    policy: Policy,
    content: str = "content",
    language: str = "language",
) -> DataFrame:
    """Ask `scorer` for an answer per record: columns `answer` and `error`.

    A batch that fails is retried record by record, so only the failing record
    carries an error.
    """
    answers = [T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())]
    schema = T.StructType(df.schema.fields + answers)
    columns = df.columns

    def one(text: str) -> tuple[str | None, str | None]:
        try:
            return str(list(scorer(pd.Series([text])))[0]), None
        except Exception as exc:  # any failure of the caller's service is a value
            return None, str(exc)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prompts = batch["_prompt"]
            try:
                pairs = [(str(a), None) for a in scorer(prompts)]
                if len(pairs) != len(prompts):
                    raise ValueError("the scorer must answer every prompt")
            except Exception:
                pairs = [one(t) for t in prompts]
            out = batch[columns].copy()
            out["answer"] = [a for a, _ in pairs]
            out["error"] = [e for _, e in pairs]
            yield out

    asked = df.withColumn("_prompt", prompt(content, policy.description, F.col(language)))
    return asked.mapInPandas(run, schema)


def ask_and_gate(df: DataFrame, scorer: Callable[[pd.Series], Sequence[str]], policy: Policy) -> DataFrame:
    """Cheap keyword filter first, then the classifier, failures kept."""
    answered = score_relevance(keyword_filter(df, policy), scorer, policy)
    return answered.where(F.coalesce(verdict("answer"), F.lit(True)))
