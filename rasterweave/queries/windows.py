"""Window functions and ordered folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.model import classes
from rasterweave.operators import selection, stats
from rasterweave.queries.aggregations import _RAREST, SAMPLER, rounded
from rasterweave.registry import query

N = 300


def _share(n: int, weight: str = "sampler_w") -> str:
    return f"greatest(1, cast(round_even(cast({n} * {weight} / sum({weight}) over () as double), 0) as bigint))"


_TOKENS = f"select class_id, cast(case when class_id = 0 then t + {N} - sum(t) over () else t end as bigint) tokens from (select class_id, {_share(N)} t from fx_classes)"


_ORDERS = "(select count(*) from orders)"


@query(oracle(f"select class_id, cast(case when class_id = 0 then t + {_ORDERS} - sum(t) over () else t end as bigint) tokens from (select class_id, {_share(_ORDERS)} t from fx_classes)", "fx_classes"))
def allocate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as there are orders."""
    return selection.allocate_tokens(classes(spark), fixture(spark, sf_dir, "orders").count())


_TILES = f"select *, {_RAREST} rarest from fx_tile_meta"


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.with_rarest(fixture(spark, sf_dir, "fx_tile_meta"), SAMPLER)


@query(oracle("select id, rarest from (select id, rarest, row_number() over (partition by rarest order by id) rn from tiles) join tokens on class_id = rarest where rn <= tokens", "fx_tile_meta", "fx_classes", tiles=_TILES, tokens=_TOKENS))
def cap_by_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.cap_by_tokens(_tiles(spark, sf_dir), selection.allocate_tokens(classes(spark), N), N).select("id", "rarest")


@query(oracle("select id, bytes from (select id, bytes, coalesce(sum(bytes) over (order by id rows between unbounded preceding and 1 preceding), 0) before from (select id, 4456448 + trow % 1000 bytes from fx_tile_meta)) where before < 20000000000", "fx_tile_meta"))
def cap_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = fixture(spark, sf_dir, "fx_tile_meta").select("id", (F.lit(4_456_448) + F.col("trow") % 1000).alias("bytes"))
    return selection.cap_by_bytes(tiles, 20_000_000_000).select("id", "bytes")


_PRESENT = "select * from fx_classes where class_id in (select rarest from tiles)"
_REPLAY = f"select class_id, {_share(N)} quota from present"


@query(oracle("select class_id, cast(quota as bigint) quota from replay", "fx_tile_meta", "fx_classes", tiles=_TILES, present=_PRESENT, replay=_REPLAY))
def allocate_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For 300 tiles the shares add up to 300, so nothing is trimmed; tests cover trimming."""
    present = classes(spark).join(_tiles(spark, sf_dir).select(F.col("rarest").alias("class_id")).distinct(), "class_id", "left_semi")
    return selection.allocate_replay(present, N)


_SELECTED = "select id, rarest, coverage from (select id, rarest, coalesce(coverage_ratio, 0e0) coverage, row_number() over (partition by rarest order by coalesce(coverage_ratio, 0e0) desc, id) rn from tiles) join replay on class_id = rarest where rn <= quota"


@query(oracle(_SELECTED, "fx_tile_meta", "fx_classes", tiles=_TILES, present=_PRESENT, replay=_REPLAY))
def replay_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = selection.replay_select(fixture(spark, sf_dir, "fx_tile_meta"), classes(spark), SAMPLER, N)
    return chosen.select("id", "rarest", F.col("coverage_ratio").alias("coverage"))


_IMPROVED = "select run_id, epoch, val_miou, val_miou > coalesce(greatest(max(val_miou) over (partition by run_id order by epoch rows between unbounded preceding and 1 preceding), 0), 0) improved from fx_epochs"
EARLY_SQL = """select run_id, epoch, best, since, since >= 12 and count_if(since >= 12) over (partition by run_id order by epoch rows unbounded preceding) = 1 stop from (select run_id, epoch,
 greatest(max(val_miou) over (partition by run_id order by epoch rows unbounded preceding), 0) best, epoch - coalesce(max(case when improved then epoch end) over (partition by run_id order by epoch rows unbounded preceding), 0) since from improved)"""


@query(oracle(EARLY_SQL, "fx_epochs", improved=_IMPROVED))
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.early_stop(fixture(spark, sf_dir, "fx_epochs")).select("run_id", "epoch", "best", "since", "stop")


@query("with recursive " + oracle("""select run_id, cast(s as bigint) steps, round(e, 6) ema from (select *, row_number() over (partition by run_id order by s desc) k from f) where k = 1""", "fx_epochs",
    f="select run_id, 1 s, val_miou e from fx_epochs where epoch = 1 union all select f.run_id, f.s + 1, least(0.9998e0, (2e0 + f.s) / (11e0 + f.s)) * f.e + (1 - least(0.9998e0, (2e0 + f.s) / (11e0 + f.s))) * x.val_miou from f join fx_epochs x on x.run_id = f.run_id and x.epoch = f.s + 1").removeprefix("with "))
def ema_warmup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(selection.ema_warmup(fixture(spark, sf_dir, "fx_epochs"), "run_id", "epoch", "val_miou"), "ema")


_METRICS = ("tr_loss", "val_loss", "tr_mIoU", "val_mIoU")


def _metric(name: str) -> str:
    return f"regexp_extract(line, '(?:^|\\s){name}=([0-9.]+)', 1)"


@query(oracle("select run_id, " + ", ".join(f"coalesce(arg_max({_metric(m)}, line_no) filter (where {_metric(m)} <> ''), '0') \"{m}\"" for m in _METRICS) + ", '0' lr, cast(count_if(line like 'Epoch %') as bigint) epochs from fx_log group by 1", "fx_log"))
def last_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.last_metric(fixture(spark, sf_dir, "fx_log"), [*_METRICS, "lr"])


@query(oracle("select run_id, left(string_agg(line, chr(10) order by line_no), 2000) tail from (select *, row_number() over (partition by run_id order by line_no desc) rn from fx_log) where rn <= 40 group by 1", "fx_log"))
def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.log_tail(fixture(spark, sf_dir, "fx_log"))


@query(oracle("select shard, cast(count(*) as bigint) n, count(*) * 100e0 / sum(count(*)) over () percent from fx_tile_meta group by 1", "fx_tile_meta"))
def percent_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = fixture(spark, sf_dir, "fx_tile_meta").groupBy("shard").agg(F.count("*").alias("n"))
    return stats.percent_of_total(counts, counts.agg(F.sum("n").alias("total")))


@query(oracle("select id, cast(floor((rn - 1) / 7) as bigint) batch from (select id, row_number() over (order by id) rn, count(*) over () n from fx_tile_meta) where rn <= n // 7 * 7", "fx_tile_meta"))
def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.assign_batches(fixture(spark, sf_dir, "fx_tile_meta").select("id"), "id", 7)


