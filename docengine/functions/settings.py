"""Device, precision and language-model settings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Device names that are understood, and what each stands for.
DEVICES = {"amd": "cuda", "auto": "__auto__", "cpu": "cpu", "cuda": "cuda", "mps": "mps", "nvidia": "cuda", "rocm": "cuda"}
PRECISIONS = ["bfloat16", "float16", "float32"]
# Settings of each service, and the option each becomes, in order of precedence.
SERVICES = {
    "ollama": {"OLLAMA_BASE_URL": "ollama_base_url", "OLLAMA_MODEL": "ollama_model"},
    "openai": {"OPENAI_API_KEY": "openai_api_key", "OPENAI_BASE_URL": "openai_base_url", "OPENAI_MODEL": "openai_model"},
    "claude": {"CLAUDE_API_KEY": "claude_api_key", "CLAUDE_MODEL": "claude_model_name"},
}
#: Which settings call for a service (a model alone does so only for the first).
CALLS = {"ollama": ["OLLAMA_BASE_URL", "OLLAMA_MODEL"], "openai": ["OPENAI_API_KEY"], "claude": ["CLAUDE_API_KEY"]}
SERVICE_KEY = "DOCENGINE_LLM_SERVICE"
OPTION_PREFIXES = ("ollama_", "openai_", "claude_", "gemini_")


def named(value: str, table: dict[str, str], what: str) -> str | None:
    """What one name stands for, outside of a query; blank is none, unknown raises."""
    name = value.strip().lower()
    if name and name not in table:
        raise ValueError(f"Unsupported {what}={value}. Expected one of: {', '.join(sorted(table))}.")
    return table.get(name)


def _one_of(value: Column, table: dict[str, str], what: str) -> Column:
    name = F.nullif(F.lower(F.trim(value)), F.lit(""))
    known = F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), name)
    text = F.concat(F.lit(f"Unsupported {what}="), value, F.lit(f". Expected one of: {', '.join(sorted(table))}."))
    return F.when(name.isNull(), F.lit(None).cast("string")).when(known.isNull(), F.raise_error(text)).otherwise(known)


def device(value: Column) -> Column:
    """The device of a name; blank is none, unknown raises."""
    return _one_of(value, DEVICES, "device")


def precision(value: Column) -> Column:
    return _one_of(value, {p: p for p in PRECISIONS}, "precision")


def llm_service(env: Column) -> Column:
    """The service that a map of settings asks for, or null for the default one.

    An explicit name wins, then the services in their order. Empty settings count as unset.
    """
    has = lambda k: F.coalesce(F.try_element_at(env, F.lit(k)) != "", F.lit(False))
    rule = F.when(has(SERVICE_KEY), F.try_element_at(env, F.lit(SERVICE_KEY)))
    for name, keys in CALLS.items():
        asked = has(keys[0])
        for k in keys[1:]:
            asked = asked | has(k)
        rule = rule.when(asked, name)
    return rule


def llm_options(env: Column) -> Column:
    """map<string,string> of the options that settings give; other services' settings pass through."""
    pairs = [F.struct(F.lit("llm_service").alias("key"), llm_service(env).alias("value"))]
    for table in SERVICES.values():
        pairs += [F.struct(F.lit(option).alias("key"), F.nullif(F.try_element_at(env, F.lit(k)), F.lit("")).alias("value")) for k, option in table.items()]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda e: e["value"].isNotNull()))


def llm_options_of(env: Mapping[str, str]) -> dict[str, str]:
    """The same for one environment, for use outside of a query."""
    called = next((s for s, keys in CALLS.items() if any(env.get(k) for k in keys)), None)
    service = env.get(SERVICE_KEY) or called
    out = {"llm_service": service} if service else {}
    return out | {option: env[k] for table in SERVICES.values() for k, option in table.items() if env.get(k)}
