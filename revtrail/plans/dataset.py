"""The raw tables of one business with everything that derives from them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revtrail.operators import cleaning, features, forecast, segments, star
from revtrail.operators.joins import Heavy, heavy_keys, many_to_one
from revtrail.operators.lineage import checkpointed
from revtrail.params import Params
from revtrail.sources import dimensions, files, fixtures


class Dataset:
    """Tables are opened when a question first needs them."""

    def __init__(
        self, spark: SparkSession, tables: dict[str, Callable[[], DataFrame]], params: Params
    ) -> None:
        self.spark = spark
        self.params = params
        self.heavy: Mapping[str, Heavy] = {}
        self._tables = tables

    @classmethod
    def of(
        cls,
        leads: DataFrame,
        opportunities: DataFrame,
        closed_deals: DataFrame,
        reps: DataFrame,
        params: Params | None = None,
    ) -> Dataset:
        tables = {
            "leads": leads,
            "opportunities": opportunities,
            "closed_deals": closed_deals,
            "dim_rep": reps,
        }
        opened = {name: (lambda rows=rows: rows) for name, rows in tables.items()}
        return cls(leads.sparkSession, opened, params or Params())

    @classmethod
    def from_testdata(cls, spark: SparkSession, folder: str) -> Dataset:
        builders = {
            "leads": fixtures.leads,
            "opportunities": fixtures.opportunities,
            "closed_deals": fixtures.closed_deals,
            "dim_rep": fixtures.reps,
        }
        tables = {name: partial(build, spark, folder) for name, build in builders.items()}
        return cls(spark, tables, fixtures.FIXTURE_PARAMS)

    @classmethod
    def from_files(
        cls, spark: SparkSession, folder: str, params: Params, fmt: str = "parquet"
    ) -> Dataset:
        names = ("leads", "opportunities", "closed_deals", "dim_rep")
        tables = {
            name: partial(files.read_table, spark, f"{folder}/{name}", name, fmt) for name in names
        }
        return cls(spark, tables, params)

    @cached_property
    def leads(self) -> DataFrame:
        return self._tables["leads"]()

    @cached_property
    def opportunities(self) -> DataFrame:
        return self._tables["opportunities"]()

    @cached_property
    def closed_deals(self) -> DataFrame:
        return self._tables["closed_deals"]()

    @cached_property
    def reps(self) -> DataFrame:
        return self._tables["dim_rep"]()

    @cached_property
    def leads_clean(self) -> DataFrame:
        return cleaning.leads_clean(self.leads, self.params)

    @cached_property
    def deals_clean(self) -> DataFrame:
        return cleaning.closed_deals_clean(self.closed_deals, self.params)

    def opportunities_clean(
        self, columns: Iterable[str] = cleaning.OPPORTUNITY_COLUMNS
    ) -> DataFrame:
        columns = list(columns)
        counts = self.arr_counts if {"arr_value", "arr_imputed_flag"} & set(columns) else None
        return cleaning.opportunities_clean(
            self.opportunities, self.leads, self.params, columns, self.heavy.get("lead_id"), counts
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        """The days that the facts span, within the calendar of the settings."""
        facts = ((self.opportunities, ("created_date", "close_date")), (self.closed_deals, ("close_date",)))
        tables = [rows.select(F.explode(F.array(*days)).alias("date")) for rows, days in facts]
        return dimensions.date_spine(tables, self.params.first_day, self.params.last_day)

    @cached_property
    def arr_counts(self) -> DataFrame:
        """`cleaning.arr_counts`, written down once: medians, filled-in values and size bands
        all read them, and one distinct value a row is far less than the facts behind it."""
        return checkpointed(
            cleaning.arr_counts(self.opportunities, self.leads, self.params, self.heavy.get("lead_id"))
        )

    def clean_arr_counts(self) -> DataFrame:
        """How often each cleaned deal value occurs."""
        return cleaning.filled_counts(self.arr_counts)

    def find_heavy_keys(self) -> dict[str, Heavy]:
        """Look for heavy keys of both facts, one job each, and use them in all later plans.

        Without it joins rely on adaptive execution, which meets skew only where it shuffles.
        """
        self.heavy = {
            **heavy_keys(self.closed_deals, ["opp_id"], self.params),
            **heavy_keys(self.opportunities, ["lead_id", "owner_id"], self.params),
        }
        return self.heavy

    def opportunity_base(self, columns: Iterable[str]) -> DataFrame:
        """Cleaned opportunities with their own features; steps that nobody asks for are left out."""
        columns = list(columns)
        wanted = set(columns)
        base = wanted - set(star.FEATURES)
        if wanted & {"days_since_created", "is_stalled"}:
            base |= {"stage", "created_date"}
        if "deal_size_band" in wanted:
            base.add("arr_value")
        rows = self.opportunities_clean(sorted(base))
        if wanted & {"days_since_created", "is_stalled"}:
            rows = features.with_pipeline_age(rows, self.params)
        if "is_stalled" in wanted:
            rows = features.with_stalled_flag(rows, self.opportunities, self.params)
        if "deal_size_band" in wanted:
            rows = features.with_size_band(rows, self.clean_arr_counts())
        return rows.select(*columns)

    @cached_property
    def deal_clusters(self) -> DataFrame:
        """Every deal with its k-means cluster and archetype; fitted once per dataset."""
        columns = ["deal_id", "customer_segment", *segments.FEATURE_COLUMNS]
        return segments.kmeans_segments(self.deal_view(columns), self.params)

    def opportunity_view(self, columns: Iterable[str], date_role: str = "close") -> DataFrame:
        return star.opportunity_view(self, columns, date_role)

    def deal_view(self, columns: Iterable[str]) -> DataFrame:
        return star.deal_view(self, columns)

    def build(self, folder: str, fmt: str = "parquet") -> BuiltDataset:
        """Write the clean and modelled tables once, and give the dataset that reads them."""
        written = files.write_outputs(
            {
                "leads_clean": self.leads_clean,
                "opportunities_clean": self.opportunities_clean(),
                "closed_deals_clean": self.deals_clean,
                "dim_date": self.dim_date.select(*files.schema_of("dim_date").names),
                "dim_rep": self.reps,
            },
            folder,
            fmt,
        )
        clean = BuiltDataset(self, folder, fmt, dict(written))
        written |= files.write_outputs(
            {
                "opportunities_modelled": clean.opportunity_base(
                    [*cleaning.OPPORTUNITY_COLUMNS, *star.FEATURES]
                ),
                "deal_clusters": clean.deal_clusters,
                "forecast_summary": forecast.forecast_summary(
                    clean.opportunities_clean(["stage", "arr_value", "close_probability", "created_date"]),
                    self.params,
                ),
            },
            folder,
            fmt,
        )
        whole = BuiltDataset(self, folder, fmt, written)
        files.write_outputs({"closed_deals_segmented": whole.deal_view(star.SEGMENTED_COLUMNS)}, folder, fmt)
        return whole


class BuiltDataset(Dataset):
    """A dataset that reads its clean and modelled tables where `build` wrote them.

    The raw tables are those of the dataset it was built from. `known` gives the types of
    the tables that are there already; without it all are, and CSV cannot be read.
    """

    def __init__(
        self,
        raw: Dataset,
        folder: str,
        fmt: str = "parquet",
        known: Mapping[str, StructType] | None = None,
    ) -> None:
        super().__init__(raw.spark, raw._tables, raw.params)
        self.heavy = raw.heavy
        self._folder, self._fmt, self._known = folder, fmt, known

    def _built(self, table: str) -> DataFrame | None:
        """A written table with the types it was written with."""
        if self._known is not None and table not in self._known:
            return None
        schema = self._known and self._known[table]
        return files.read_back(self.spark, f"{self._folder}/{table}", self._fmt, schema)

    @cached_property
    def leads_clean(self) -> DataFrame:
        rows = self._built("leads_clean")
        return super().leads_clean if rows is None else rows

    @cached_property
    def deals_clean(self) -> DataFrame:
        rows = self._built("closed_deals_clean")
        return super().deals_clean if rows is None else rows

    @cached_property
    def deal_clusters(self) -> DataFrame:
        rows = self._built("deal_clusters")
        return super().deal_clusters if rows is None else rows

    def _wide(self, table: str, own: Iterable[str], columns: list[str]) -> DataFrame | None:
        """Columns of a written opportunity table, further lead attributes joined to it."""
        rows = self._built(table)
        if rows is None:
            return None
        more = [c for c in columns if c not in own]
        if more:
            leads = self.leads_clean.select("lead_id", *more)
            kept = dict.fromkeys([*[c for c in columns if c in own], "lead_id"])
            rows = many_to_one(rows.select(*kept), leads, "lead_id", self.heavy.get("lead_id"))
        return rows.select(*columns)

    def opportunities_clean(
        self, columns: Iterable[str] = cleaning.OPPORTUNITY_COLUMNS
    ) -> DataFrame:
        columns = list(columns)
        rows = self._wide("opportunities_clean", cleaning.OPPORTUNITY_COLUMNS, columns)
        return super().opportunities_clean(columns) if rows is None else rows

    def clean_arr_counts(self) -> DataFrame:
        rows = self._built("opportunities_clean")
        return super().clean_arr_counts() if rows is None else features.arr_times(rows)

    def opportunity_base(self, columns: Iterable[str]) -> DataFrame:
        columns = list(columns)
        own = (*cleaning.OPPORTUNITY_COLUMNS, *star.FEATURES)
        if not set(columns) & set(star.FEATURES):
            return self.opportunities_clean(columns)
        rows = self._wide("opportunities_modelled", own, columns)
        return super().opportunity_base(columns) if rows is None else rows
