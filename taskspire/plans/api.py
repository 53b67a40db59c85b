"""The query interface: methods by path, parameters checked, results as tables with metadata (§2.13, §2.14, K12)."""

from __future__ import annotations

import inspect
import re
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspire.operators import chain, search, stats, steps
from taskspire.operators.selection import by_prefix, selection
from taskspire.schema import STEP_TYPES

VERSION = "0.3.0"


# The codes of the interface's errors.
class ApiError(Exception):
    code = 500


class NotImplementedYet(ApiError):
    code = 501


class CategoryNotFound(ApiError):
    code = 461


class InvalidCategoryName(ApiError):
    code = 462


class MethodFailed(ApiError):
    code = 470


class MethodNotFound(MethodFailed):
    code = 471


class MethodExists(MethodFailed, ValueError):
    code = 472


class MissedParameter(MethodFailed):
    code = 473


class InvalidParameter(MethodFailed):
    code = 474


class NoDataFound(MethodFailed):
    """Nothing there to answer from; a plain failure of the method."""


class ConfigurationError(ApiError):
    code = 590


class ConfigurationNotFound(ConfigurationError):
    code = 591


@dataclass
class Result:
    """A table, not computed yet, and what is known beside it. Values of ``meta`` that are functions start jobs of their own when they are called."""

    data: DataFrame
    meta: dict[str, Any] = field(default_factory=dict)


def standard_path(path: str) -> str:
    """F24. Single slashes, one in front, none behind."""
    return "/" + re.sub("/+", "/", path).strip("/")


@dataclass
class Engine:
    """Queries over the tables of tasks: production and, if there is one, analysis. ``clock`` tells the time, in UTC."""

    production: DataFrame
    analysis: DataFrame | None = None
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc).replace(tzinfo=None)
    methods: dict[str, Callable[..., Result]] = field(init=False)

    def __post_init__(self) -> None:
        self.methods = {"/": self.info, "/server_info": self.info, "/task/hist": self.task_hist, "/task/chain": self.task_chain, "/task/kwsearch": self.task_kwsearch, "/task/deriv": self.task_deriv, "/campaign/stat": self.campaign_stat, "/step/stat": self.step_stat}

    def add(self, path: str, method: Callable[..., Result]) -> None:
        """Registers a method; a path may hold * for any part."""
        path = standard_path(path)
        if not all(re.fullmatch(r"[\w*.-]+", part) for part in path.strip("/").split("/")):
            raise InvalidCategoryName(path)
        if path in self.methods:
            raise MethodExists(f"{path} is taken")
        self.methods[path] = method

    def call(self, path: str, **params: Any) -> Result:
        """By exact path, else by the last pattern in order that fits. Under /nested the nested layout is used where a method has one, else the flat one with a warning. A category's info lists its methods."""
        began, at = time.time(), standard_path(path)
        nested = at == "/nested" or at.startswith("/nested/")
        at = standard_path(at.removeprefix("/nested")) if nested else at
        method = self.methods.get(at)
        if method is None and at.endswith("/info"):
            found = sorted(m for m in self.methods if m.startswith(at.removesuffix("info")))
            if found:
                return Result(self.production.sparkSession.createDataFrame([(m,) for m in found], "method string"))
        for pattern in sorted(self.methods, reverse=True) if method is None else ():
            if "*" in pattern and re.fullmatch(re.escape(pattern).replace(r"\*", "[^/]+"), at):
                method = self.methods[pattern]
                break
        if method is None:
            raise (CategoryNotFound if at.endswith("/info") else MethodNotFound)(path)
        warning = None
        if nested and "layout" in inspect.signature(method).parameters:
            params["layout"] = "nested"
        elif nested:
            warning = "no nested variant; the flat one was used"
        result = method(**params)
        result.meta["took_total_ms"] = round((time.time() - began) * 1000)
        if warning:
            result.meta.setdefault("warning", []).append(warning)
        return result

    def respond(self, path: str, **params: Any) -> dict[str, Any]:
        """K12. A method's answer, computed: status, data as a list of rows, and what is known beside them; errors as status, code and text. Answers are tables of a bounded size; a method's ``timeout`` (seconds) stops its jobs."""
        began = time.time()
        sc, tag = self.production.sparkSession.sparkContext, f"request-{uuid.uuid4().hex}"
        timer = None
        try:
            result = self.call(path, **params)
            seconds = result.meta.pop("timeout", None)
            if seconds:
                timer = threading.Timer(seconds, sc.cancelJobsWithTag, (tag,))
                timer.start()
            sc.addJobTag(tag)
            rows = [r.asDict(True) for r in result.data.toLocalIterator()]
            meta = {k: v() if callable(v) else [r.asDict(True) for r in v.collect()] if isinstance(v, DataFrame) else v for k, v in result.meta.items()}
            return {"status": "OK", **meta, "data": rows, "took_total_ms": round((time.time() - began) * 1000)}
        except ApiError as e:
            return {"status": "failed", "code": e.code, "text": str(e), "took_total_ms": round((time.time() - began) * 1000)}
        except Exception as e:
            if timer is None or timer.is_alive():
                raise
            return {"status": "failed", "code": MethodFailed.code, "text": f"{path}: no answer in time ({type(e).__name__})", "took_total_ms": round((time.time() - began) * 1000)}
        finally:
            if timer is not None:
                timer.cancel()
            sc.removeJobTag(tag)

    def info(self) -> Result:
        rows = [(m, (f.__doc__ or "").strip().split("\n")[0], VERSION) for m, f in sorted(self.methods.items())]
        return Result(self.production.sparkSession.createDataFrame(rows, "method string, about string, version string"))

    @staticmethod
    def _select(tasks: DataFrame, params: dict[str, Any]) -> DataFrame:
        if not params:
            raise MissedParameter("selection parameters")
        return tasks.where(selection(tasks, {k: by_prefix(v) if v is not None else None for k, v in params.items()}))

    @staticmethod
    def _step_type(step_type: str | None) -> str:
        if step_type not in (None, *STEP_TYPES):
            raise InvalidParameter(f"step_type: {step_type}")
        return step_type or "step"

    @staticmethod
    def _whole(name: str, value: Any) -> int:
        try:
            n = int(value)
        except (TypeError, ValueError):
            n = 0
        if n < 1:
            raise InvalidParameter(f"{name}: {value}")
        return n

    def task_hist(self, htags: Any = None, start: datetime | None = None, end: datetime | None = None, detailed: bool = False, bins: Any = None, rtype: str = "table") -> Result:
        """Tasks running on each day, by step; with ``bins``, added up over so many equal spans of days. ``rtype`` 'json': a row for each step with its days (or first days of spans) and numbers."""
        if rtype not in ("table", "json"):
            raise MethodFailed(f"response type {rtype}")
        if htags is None:
            raise MissedParameter("htags")
        got = stats.running_days(self.production, [t.lower() for t in (htags if isinstance(htags, list) else htags.split(","))], self.clock(), start, end)
        if not detailed:
            got = got.withColumn("step", steps.merged_name(F.col("step")))
        if bins is not None:
            got = stats.binned_days(got, self._whole("bins", bins))
        if rtype == "json":
            got = got.groupBy("step").agg(F.array_sort(F.collect_list(F.struct(F.col("day").cast("string").alias("x"), F.col("tasks").alias("y")))).alias("p")).select("step", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
            return Result(got.orderBy(steps.chart_order(F.col("step")), "step"))
        return Result(got.orderBy(steps.chart_order(F.col("step")), "step", "day"))

    def task_chain(self, tid: int | None = None) -> Result:
        """The chain to which a task belongs."""
        if tid is None:
            raise MissedParameter("tid")
        got = chain.chain_of(self.production, int(tid))
        if not got.limit(1).count():
            raise NoDataFound(f"task {tid}")
        return Result(got)

    def task_kwsearch(self, kw: Any = None, analysis: bool | None = None, production: bool | None = None, size: Any = 2000, ds_size: Any = 20, timeout: Any = 120) -> Result:
        """Tasks that have all keywords. Naming one kind of tasks alone turns the other off."""
        if kw is None:
            raise MissedParameter("kw")
        if analysis is None and production is None:
            analysis = production = True
        analysis, production = (not production if analysis is None else analysis), (not analysis if production is None else production)
        tables = [t for t, on in ((self.production, production), (self.analysis, analysis)) if on and t is not None]
        if not analysis and not production:
            raise InvalidParameter("analysis and production are both off")
        from taskspire.operators.upsert import union_all

        size, ds_size, timeout = self._whole("size", size), self._whole("ds_size", ds_size), self._whole("timeout", timeout)
        if not tables:
            return Result(self.production.limit(0), {"total": lambda: 0, "timeout": timeout})
        found = search.keyword_search(union_all(*tables), kw if isinstance(kw, list) else [kw], None, ds_size)
        return Result(found.orderBy("taskid").limit(size), {"total": found.count, "timeout": timeout})

    def task_deriv(self, project: str | None = None, amitag: Any = None, layout: str = "flat") -> Result:
        """Derivations of a project and tags, by format."""
        if project is None or amitag is None:
            raise MissedParameter("project, amitag")
        picked = self.derivation_tasks(self.production, project, amitag if isinstance(amitag, list) else [amitag])
        if layout == "nested":
            return Result(stats.derivations_nested(picked).orderBy("output"))
        return Result(stats.derivations_flat(picked).orderBy("output"), {"warning": ["general formats are left out"]})

    @staticmethod
    def derivation_tasks(tasks: DataFrame, project: str, tags: list[str]) -> DataFrame:
        from taskspire.functions.names import name_tokens

        is_derivation = F.arrays_overlap(name_tokens("primary_input"), F.array(F.lit("aod"), F.lit("rpvll")))
        return tasks.where(is_derivation & (F.lower("project") == project.lower()) & F.col("ctag").isin(*tags) & (F.col("status") == "done") & (F.col("input_bytes") > 0))

    def campaign_stat(self, step_type: str | None = None, events_src: str = "all", layout: str = "flat", **params: Any) -> Result:
        """A campaign's events, ratios and times by step."""
        if events_src not in ("ds", "task", "all"):
            raise InvalidParameter(f"events_src: {events_src}")
        tasks, kind = self._select(self.production, params), self._step_type(step_type)
        now = self.clock()
        meta = {"total": tasks.count, "statuses": stats.campaign_statuses(tasks, now, kind, layout), "daily": stats.campaign_daily(tasks, kind, layout), "last_update": lambda: tasks.agg(F.max("task_timestamp")).first()[0]}
        return Result(stats.campaign_summary(tasks, now, kind, events_src, layout), meta)

    def step_stat(self, step_type: str | None = None, layout: str = "flat", es_compat: bool = False, **params: Any) -> Result:
        """Statistics by step."""
        kind = self._step_type(step_type)
        tasks = self._select(self.production, params)
        got = stats.step_statistics(tasks, kind, layout, es_compat)
        order = [steps.step_order(F.col("step")), F.col("step")] if kind == "step" else [F.desc_nulls_last("input_events"), F.col("step")]
        return Result(got.orderBy(*order), {"total": tasks.count})
