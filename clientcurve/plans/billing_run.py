"""One run of the client-billing analysis, as a set of lazily defined
DataFrames that share their intermediate plans.

Materialisation points (checkpoints to the shared folder, each written
once per run and read by every later step):

* ``facts`` - the single reduction of the invoice history, one row per
  client (billing span + window revenue); the fact table is scanned once,
  and every later step (revenue, dates, roll-up, profile) reads this table;
* ``group_facts`` - the single group-level reduction of ``facts`` through
  the code map (window revenue, active-group set, group billing span);
* the per-group table with its per-range-partition running sums inside the
  ABC curve (see operators.prefix);
* ``org_status`` - the organisation frame before the group roll-up, which
  reads it twice (grouped MIN and join back).

Everything else is lazy. ``write_outputs`` is the scheduled job: it writes
every output once and reads the stored tables back as the inputs of the
outputs derived from them (flagged frame -> changes -> reports; headcount ->
demand -> profile).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as O
from ..config import RunConfig
from ..operators import distinct_sketch
from ..session import materialize
from ..sinks import publish, writers

# Mean demand is reported, and classified, at 6 decimal places.
DEMAND_PRECISION = 6


class BillingRun:
    """Outputs of one run over the four logical inputs."""

    def __init__(
        self,
        invoices: DataFrame,
        employees: DataFrame,
        orgs: DataFrame,
        cfg: RunConfig | None = None,
        delivery_log: DataFrame | None = None,
        num_partitions: int | None = None,
        facts: DataFrame | None = None,
    ):
        self.invoices = invoices
        self.employees = employees
        self.orgs = orgs
        self.delivery_log = delivery_log
        self.cfg = cfg or RunConfig()
        self.num_partitions = num_partitions
        self._from_state = facts is not None
        if facts is not None:  # kept up to date by operators.billing_state; the invoices are not read
            self.__dict__["facts"] = facts

    @property
    def _window_days(self) -> int:
        return (self.cfg.window_end - self.cfg.window_start).days

    @cached_property
    def billed(self) -> DataFrame:
        """Invoices that billing dates may see."""
        if self.cfg.billing_until_as_of:
            return self.invoices.where(F.col("issue_date") <= F.lit(self.cfg.as_of))
        return self.invoices

    # ------------------------------------------------------------ revenue / ABC
    @cached_property
    def code_map(self) -> DataFrame:
        return O.explode_codes(self.orgs)

    @cached_property
    def client_rev(self) -> DataFrame:
        return O.client_month_revenue(self.invoices, self.cfg.window_end, self._window_days)

    @cached_property
    def facts(self) -> DataFrame:
        return materialize(O.client_facts(self.billed, self.cfg.window_end, self._window_days))

    @cached_property
    def group_facts(self) -> DataFrame:
        return materialize(O.group_facts(self.facts, self.code_map, self.cfg.dedupe_shared_codes))

    @cached_property
    def group_rev(self) -> DataFrame:
        """Window revenue of the groups. Its scan reads the window only; a run
        that has reduced the whole history already takes it from there."""
        if self._from_state or "group_facts" in self.__dict__:
            return O.group_window_revenue(self.group_facts)
        return O.group_revenue(self.client_rev, self.code_map, self.cfg.dedupe_shared_codes)

    @cached_property
    def abc(self) -> DataFrame:
        return O.abc_classify(self.group_rev, self.cfg.a_max_share, self.cfg.b_max_share, self.num_partitions)

    @cached_property
    def cumulative(self) -> DataFrame:
        return O.cumulative_revenue(self.group_rev, self.num_partitions)

    # ----------------------------------------------------------- billing dates
    @cached_property
    def span(self) -> DataFrame:
        if "facts" in self.__dict__:
            return self.facts.select("client_code", "first_billed", "last_billed")
        return O.billing_span(self.billed)

    @cached_property
    def org_dates(self) -> DataFrame:
        return O.org_dates(self.code_map, self.span)

    # ------------------------------------------------- organisation frame
    @cached_property
    def org_abc(self) -> DataFrame:
        return O.org_abc(self.orgs, self.abc)

    @cached_property
    def org_status(self) -> DataFrame:
        """Snapshot + computed class, dates, recency and status (no roll-up).

        Dates are joined on ``id`` first, so the class join, the group
        roll-up aggregate and its join-back all run on one ``econ_group``
        partitioning of the organisation frame."""
        _ = self.facts, self.group_facts  # both the span and the class: one pass over the history
        frame = O.org_abc(self.orgs.join(self.org_dates, "id", "left"), self.abc)
        # Materialised: the group roll-up reads this frame twice (grouped MIN
        # and the join back), which would otherwise recompute its joins.
        return materialize(O.activity_status(frame, self.cfg.as_of, self.cfg.active_days))

    @cached_property
    def org_dated(self) -> DataFrame:
        """Snapshot + dates, recency and status: no class, hence no revenue."""
        return O.activity_status(self.orgs.join(self.org_dates, "id", "left"), self.cfg.as_of, self.cfg.active_days)

    @cached_property
    def org_rollup(self) -> DataFrame:
        return O.group_status_rollup(self.org_status, self.cfg.active_days)

    @cached_property
    def flagged(self) -> DataFrame:
        return O.flag_changes(self.org_rollup, self.cfg.billing_include_first)

    @cached_property
    def changed(self) -> DataFrame:
        return O.changed_orgs(self.flagged)

    # ----------------------------------------------------------------- reports
    @cached_property
    def curve_summary(self) -> DataFrame:
        return O.curve_summary(self.changed)

    @cached_property
    def curve_movers(self) -> DataFrame:
        return O.curve_movers(self.changed)

    @cached_property
    def outbox(self) -> DataFrame:
        return O.update_outbox(self.changed)

    @cached_property
    def payload(self) -> DataFrame:
        return O.update_payload(self.outbox, self.cfg.field_keys)

    # -------------------------------------------------- headcount and demand
    @cached_property
    def active_groups(self) -> DataFrame:
        """Groups with revenue in the window."""
        return self.group_rev.select("econ_group")

    @cached_property
    def grid(self) -> DataFrame:
        return O.group_month_grid(self.active_groups, self.cfg.window_start, self.cfg.window_end)

    @cached_property
    def intervals(self) -> DataFrame:
        return O.headcount_intervals(self.employees, self.code_map)

    @cached_property
    def window_intervals(self) -> DataFrame:
        """Intervals that touch a month of the window; the bounds are plain date
        predicates, so they reach the scan of the employees."""
        last_day = F.last_day(F.lit(self.cfg.window_end))
        first_day = F.lit(self.cfg.window_start.replace(day=1))
        touching = (F.col("admitted") <= last_day) & (F.col("dismissed").isNull() | (F.col("dismissed") >= first_day))
        return O.headcount_intervals(self.employees.where(touching), self.code_map)

    @cached_property
    def headcount(self) -> DataFrame:
        return O.active_headcount(self.window_intervals, self.active_groups, self.cfg.window_start, self.cfg.window_end)

    @cached_property
    def demand(self) -> DataFrame:
        return O.demand_mom(self.headcount)

    @cached_property
    def mean_demand(self) -> DataFrame:
        return O.mean_demand(self.demand, self.active_groups)

    @cached_property
    def group_span(self) -> DataFrame:
        return self.group_facts.select("econ_group", "first_billed", "last_billed")

    @cached_property
    def profile(self) -> DataFrame:
        _ = self.group_facts  # revenue and span: one pass over the history
        return O.rdm_profile(self.mean_demand, self.group_rev, self.group_span, self.cfg.as_of)

    def recency_segments(self, dim_recency: DataFrame) -> DataFrame:
        return O.segment(self.profile, dim_recency, "days_since_last", "recency_segment")

    def demand_segments(self, dim_demand: DataFrame) -> DataFrame:
        return O.segment(self.profile, dim_demand, "mean_demand", "demand_segment", DEMAND_PRECISION)

    # -------------------------------------------------------------- the job
    def write_outputs(
        self, out_dir: str, dim_recency=None, dim_demand=None, http_codes=None, history: str | None = None, rejects: DataFrame | None = None, keep: int = 2
    ) -> dict[str, str]:
        """Write every output under ``out_dir/run_date=<as_of>`` (a shared folder)
        and return the paths; other runs' outputs stay. The tables of a run are
        published together (``sinks.publish``): until all are written, and after a
        failure, readers see those of the run before, of which ``keep`` versions
        stay. The history of all runs is one table, at ``history``
        (``out_dir/history`` by default). An output that later outputs derive from
        is written once and read back as their input, so no chain is computed twice
        and the lineage of every later step starts at a stored table."""
        spark = self.orgs.sparkSession
        root = out_dir.rstrip("/")
        out = f"{root}/run_date={self.cfg.as_of}"
        draft = publish.Draft(spark, out)
        paths: dict[str, str] = {}

        def put(df: DataFrame, name: str) -> DataFrame:
            paths[name] = draft.path(name)
            return draft.write(df, name)

        try:
            self._write_all(put, paths, root, dim_recency, dim_demand, http_codes, history, rejects)
        except BaseException:
            draft.discard()
            raise
        draft.commit({"as_of": str(self.cfg.as_of)})
        publish.expire(spark, out, keep)
        return paths

    def _write_all(self, put, paths, root, dim_recency, dim_demand, http_codes, history, rejects) -> None:
        # The job needs the whole history once, and everything else from that.
        _ = self.facts, self.group_facts
        put(self.abc, "group_revenue")
        flagged = put(self.flagged, "org_frame")
        changed = put(O.changed_orgs(flagged), "changed_orgs")
        put(O.curve_summary(changed), "curve_summary")
        put(O.curve_movers(changed), "curve_movers")
        put(O.status_movers(changed), "status_movers")
        if rejects is not None:
            put(rejects, "org_rejects")
        outbox = O.update_outbox(changed)
        records = outbox.select(
            "*", O.payload_column(self.cfg.field_keys).alias("payload"), F.lit(self.cfg.as_of).alias("run_date")
        )
        headcount = put(self.headcount, "headcount")
        demand = put(O.demand_mom(headcount), "demand")
        profile = O.rdm_profile(
            O.mean_demand(demand, self.active_groups), self.group_rev, self.group_span, self.cfg.as_of
        )
        if dim_recency is not None:
            profile = O.segment(profile, dim_recency, "days_since_last", "recency_segment")
        if dim_demand is not None:
            profile = O.segment(profile, dim_demand, "mean_demand", "demand_segment", DEMAND_PRECISION)
        put(profile, "rdm_profile")
        if self.delivery_log is not None and http_codes is not None:
            paths["delivery_report"] = writers.write_partitioned_by_run_date(
                O.delivery_report(self.delivery_log.where(F.col("run_date") == F.lit(self.cfg.as_of)), http_codes), f"{root}/delivery_report"
            )
        # Tables of all runs, partitioned by run: each replaces the run's own partition.
        paths["class_sketches"] = distinct_sketch.append_sketches(distinct_sketch.class_sketches(changed, f"{self.cfg.run_ts:%Y%m%dT%H%M%S}"), f"{root}/class_sketches")
        paths["update_outbox"] = writers.write_partitioned_by_run_date(records, f"{root}/update_outbox")
        paths["history"] = writers.append_history(changed, history or f"{root}/history", self.cfg.run_ts)
