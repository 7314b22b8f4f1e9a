"""The five domain tables as views over the TPC-H-like driver tables.

``appointments(*columns)`` joins orders or part only when a requested column needs them.  That
relies on the driver tables' referential integrity (every line has its order and its part), which
``test_binding`` checks, and saves whole shuffles of the fact table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _hundredths(column: str) -> str:
    """A two-decimal double as a whole number of hundredths, exact and much cheaper than a DECIMAL cast."""
    return f"cast(rint({column} * 100) as bigint)"


def _cents(column: str, precision: int = 12) -> str:
    return f"cast(cast({_hundredths(column)} as decimal({precision},0)) * 0.01 as decimal({precision},2))"


def _product(factor: str) -> str:
    """The fee times a whole number of hundredths, as DECIMAL with four decimals."""
    whole = f"{_hundredths('l_extendedprice')} * {factor}"
    return f"cast(cast({whole} as decimal(18,0)) * 0.0001 as decimal(18,4))"


_ZERO = "cast(0 as decimal(18,4))"
_DISCOUNT = _hundredths("l_discount")

# column -> (tables beyond lineitem, expression)
_APPOINTMENT_COLUMNS: dict[str, tuple[frozenset[str], str]] = {
    "appointment_id": (frozenset(), "l_orderkey * 8 + l_linenumber"),
    "patient_id": (frozenset({"orders"}), "o_custkey"),
    "staff_id": (frozenset(), "l_suppkey"),
    "clinic_id": (frozenset({"supplier"}), "s_nationkey"),
    "appointment_date": (frozenset(), "cast(l_shipdate as date)"),
    "specialty": (frozenset({"part"}), "p_type"),
    "appointment_type": (frozenset(), "if(l_linestatus = 'O', 'telehealth', 'in_person')"),
    "wait_days": (frozenset(), "cast(l_quantity as int)"),
    "status": (
        frozenset(),
        # Nested ifs fold under a comparison, so "completed only" reaches the scan as l_returnflag = 'N'.
        "if(l_returnflag = 'N', 'completed', if(l_returnflag = 'R', 'no_show', 'cancelled'))",
    ),
    "billing_type": (
        frozenset({"orders"}),
        "if(o_orderpriority = '1-URGENT', 'bulk_bill', if(o_orderpriority = '2-HIGH', 'gap_payment',"
        " if(o_orderpriority = '3-MEDIUM', 'private', 'self_pay')))",
    ),
    "scheduled_fee": (frozenset(), _cents("l_extendedprice")),
    "billed_amount": (
        frozenset(),
        f"case when l_returnflag = 'N' then {_product(f'(100 - {_DISCOUNT})')} else {_ZERO} end",
    ),
    "medicare_rebate": (
        frozenset({"orders"}),
        "case when l_returnflag = 'N' and o_orderpriority in ('1-URGENT', '2-HIGH') then"
        f" {_product(_hundredths('l_tax'))} else {_ZERO} end",
    ),
    "patient_gap": (
        frozenset(),
        f"case when {_DISCOUNT} <> 0 then {_product(_DISCOUNT)} end",
    ),
    "insurance_paid": (
        frozenset({"orders"}),
        f"case when l_returnflag = 'N' and o_orderpriority = '3-MEDIUM' then {_product('30')} else {_ZERO} end",
    ),
    "staff_cost": (frozenset({"part"}), _cents("p_retailprice")),
}

# Worked out before any join: each takes fewer bytes through a shuffle than what it is worked out from.
_BEFORE_JOINS = frozenset({"appointment_date", "wait_days", "scheduled_fee", "billed_amount", "patient_gap"})

_PATIENT_EXPRS = {
    "patient_id": "c_custkey",
    "full_name": "c_name",
    "gender": "case c_custkey % 3 when 0 then 'Female' when 1 then 'Male' else 'Non-binary' end",
    "age": "cast(5 + c_custkey % 80 as int)",
    "age_group": (
        "case when 5 + c_custkey % 80 < 18 then '0-17' when 5 + c_custkey % 80 < 35 then '18-34'"
        " when 5 + c_custkey % 80 < 55 then '35-54' when 5 + c_custkey % 80 < 75 then '55-74' else '75+' end"
    ),
    "date_of_birth": "date_add(date'1930-01-01', cast((c_custkey * 37) % 23000 as int))",
    "state": "r_name",
    "city": "n_name",
    "postcode": "lpad(cast(c_custkey % 10000 as string), 4, '0')",
    "medicare_number": (
        "case when c_custkey % 50 = 0 then concat('INVALID-', cast(c_custkey as string))"
        " else lpad(cast(c_custkey as string), 10, '0') end"
    ),
    "insurance_type": "c_mktsegment",
    "health_fund": "case c_custkey % 4 when 0 then 'Fund A' when 1 then 'Fund B' else 'None' end",
    "chronic_conditions": (
        "case c_custkey % 5 when 0 then 'None' when 1 then 'Diabetes' when 2 then 'Hypertension'"
        " when 3 then 'Diabetes;Hypertension' end"
    ),
    "referral_source": "n_name",
    "registration_date": "date_add(date'1994-01-01', cast(c_custkey % 1000 as int))",
    "last_visit_date": "date_add(date'1998-01-01', cast(c_custkey % 1000 as int))",
    "churn_flag": "case when c_acctbal < 0 then 1 else 0 end",
    "total_appointments": "cast(c_custkey % 12 as int)",
    "total_billed": _cents("c_acctbal", 18),
}

_STAFF_EXPRS = {
    "staff_id": "s_suppkey",
    "full_name": "s_name",
    "role": "case s_suppkey % 3 when 0 then 'GP' when 1 then 'Specialist' else 'Nurse' end",
    "specialty": "cast(null as string)",
    "clinic_id": "s_nationkey",
    "clinic_name": "n_name",
    "city": "n_name",
    "state": "r_name",
    "clinic_type": "case when r_name in ('AFRICA', 'ASIA') then 'regional' else 'metro' end",
    "years_experience": "cast(1 + s_suppkey % 30 as int)",
    "avg_patient_rating": "cast(35 + s_suppkey % 16 as double) / 1e1",
}

_SURVEY_EXPRS = {
    "survey_id": "event_id",
    "patient_id": "user_id",
    "appointment_id": "event_id * 8 + 1",
    "survey_date": "cast(ts as date)",
    "overall_score": "case when event_type = 'error' then null else cast(1 + event_id % 10 as int) end",
    "wait_time_rating": "cast(1 + event_id % 5 as int)",
    "doctor_rating": "cast(1 + (event_id % 7) % 5 as int)",
    "facility_rating": "cast(1 + event_id % 4 as int)",
    "would_recommend": "cast(event_id % 2 as int)",
    "nps_score": "case when event_type = 'error' then null else cast(10 * (1 + event_id % 10) - 50 as int) end",
    "complaint_category": "case event_type when 'error' then 'Billing' when 'click' then 'Wait Time' else 'None' end",
}

_CLAIM_EXPRS = {
    "claim_id": "o_orderkey",
    "appointment_id": "o_orderkey * 8 + 1",
    "patient_id": "o_custkey",
    "claim_date": "cast(o_orderdate as date)",
    "claim_type": (
        "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Medicare'"
        " when o_orderpriority = '3-MEDIUM' then 'Private_Insurance' else 'Self_Pay' end"
    ),
    "claimed_amount": _cents("o_totalprice", 18),
    "approved_amount": f"case when o_orderstatus = 'F' then {_cents('o_totalprice', 18)} else cast(0 as decimal(18,2)) end",
    "rejected_amount": f"case when o_orderstatus = 'F' then cast(0 as decimal(18,2)) else {_cents('o_totalprice', 18)} end",
    "claim_status": (
        "case when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then"
        " case o_orderstatus when 'F' then 'paid' when 'O' then 'unpaid' else 'partial' end"
        " else case o_orderstatus when 'F' then 'approved' when 'O' then 'rejected' else 'partial' end end"
    ),
    "rejection_reason": (
        "case when o_orderstatus = 'F' then null else case o_orderkey % 3 when 0 then 'Duplicate_Claim'"
        " when 1 then 'Eligibility_Expired' else 'Not_Covered' end end"
    ),
}


_DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
                " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _project(df: DataFrame, exprs: dict[str, str], columns: tuple[str, ...]) -> DataFrame:
    wanted = columns or tuple(exprs)
    return df.select(*[F.expr(exprs[c]).alias(c) for c in wanted])


def dirty_specialty(specialty: Column, key: Column) -> Column:
    """Four spellings of a category, chosen by key."""
    return (
        F.when(key % 4 == 0, F.lower(specialty))
        .when(key % 4 == 1, F.concat(F.lit(" "), F.upper(specialty)))
        .when(key % 4 == 2, F.concat(specialty, F.lit(" ")))
        .otherwise(specialty)
    )


def dirty_date(date: Column, key: Column) -> Column:
    """Date text in day-first, unparseable or ISO form, chosen by key."""
    return (
        F.when(key % 3 == 0, F.date_format(date, "dd/MM/yyyy"))
        .when(key % 1001 == 1, F.lit("bad"))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )


@dataclass(frozen=True)
class DomainTables:
    """Lazy domain tables over one folder of driver Parquet files."""

    spark: SparkSession
    path: str

    def driver(self, name: str) -> DataFrame:
        """A driver table under its declared schema, so no footer has to be read to plan a query."""
        return self.spark.read.schema(_DRIVER_SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")

    def patients(self, *columns: str) -> DataFrame:
        base = self.driver("customer")
        wanted = set(columns or _PATIENT_EXPRS)
        if wanted & {"state", "city", "referral_source"}:
            base = base.join(self.driver("nation"), F.expr("c_nationkey = n_nationkey"))
        if "state" in wanted:
            base = base.join(self.driver("region"), F.expr("n_regionkey = r_regionkey"))
        return _project(base, _PATIENT_EXPRS, columns)

    def staff(self, *columns: str) -> DataFrame:
        base = (
            self.driver("supplier")
            .join(self.driver("nation"), F.expr("s_nationkey = n_nationkey"))
            .join(self.driver("region"), F.expr("n_regionkey = r_regionkey"))
        )
        return _project(base, _STAFF_EXPRS, columns)

    def appointments(self, *columns: str) -> DataFrame:
        wanted = columns or tuple(_APPOINTMENT_COLUMNS)
        needed = frozenset().union(*[_APPOINTMENT_COLUMNS[c][0] for c in wanted])
        early = [c for c in wanted if c in _BEFORE_JOINS]
        base = self.driver("lineitem").withColumns({f"__{c}": F.expr(_APPOINTMENT_COLUMNS[c][1]) for c in early})
        # The large table first: its shuffle then carries keys of the others, not their columns.
        if "orders" in needed:
            base = base.join(self.driver("orders"), F.expr("l_orderkey = o_orderkey"))
        if "part" in needed:
            base = base.join(self.driver("part"), F.expr("l_partkey = p_partkey"))
        if "supplier" in needed:
            base = base.join(self.driver("supplier"), F.expr("l_suppkey = s_suppkey"))
        return base.select(*[F.col(f"__{c}").alias(c) if c in early else F.expr(_APPOINTMENT_COLUMNS[c][1]).alias(c) for c in wanted])

    def appointments_raw(self, *columns: str) -> DataFrame:
        """Appointments with dirty specialty and date text, plus repeated full rows."""
        wanted = dict.fromkeys((*(columns or _APPOINTMENT_COLUMNS), "appointment_id", "patient_id",
                                "specialty", "appointment_date"))
        key = F.col("appointment_id")
        dirty = (
            self.appointments(*wanted)
            .withColumn("specialty_raw", dirty_specialty(F.col("specialty"), key))
            .withColumn("appointment_date_raw", dirty_date(F.col("appointment_date"), key))
            .drop("specialty", "appointment_date")
            .withColumnsRenamed({"specialty_raw": "specialty", "appointment_date_raw": "appointment_date"})
        )
        copies = F.when(F.col("patient_id") % 100 == 0, F.lit(2)).otherwise(F.lit(1))
        out = dirty.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy")
        return out.select(*columns) if columns else out

    def surveys(self, *columns: str) -> DataFrame:
        return _project(self.driver("events"), _SURVEY_EXPRS, columns)

    def claims(self, *columns: str) -> DataFrame:
        return _project(self.driver("orders"), _CLAIM_EXPRS, columns)

    def order_surveys(self) -> DataFrame:
        """Lines seen as surveys of an order: many carry a date before it, for the date-repair rule."""
        return self.driver("lineitem").select(
            F.expr("l_orderkey * 8 + l_linenumber").alias("survey_id"),
            F.col("l_orderkey").alias("appointment_id"),
            F.expr("cast(l_shipdate as date)").alias("survey_date"),
        )

    def order_appointments(self) -> DataFrame:
        return self.driver("orders").select(
            F.col("o_orderkey").alias("appointment_id"),
            F.expr("cast(o_orderdate as date)").alias("appointment_date"),
        )

    def all(self) -> dict[str, DataFrame]:
        return {
            "patients": self.patients(),
            "staff": self.staff(),
            "appointments": self.appointments(),
            "satisfaction_surveys": self.surveys(),
            "billing_claims": self.claims(),
        }
