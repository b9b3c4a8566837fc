"""Pieces that the text operators share: input checks, folds, durable cut points."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A sample has so many labels at most; more are an error, as a label left out could never be predicted.
MOST_LABELS = 1000
#: Rows of an Arrow batch, where the session names no number: Spark's 10,000 documents take some 30 MB,
#: held several times over by each task's JVM side and by each of its Python workers.
BATCH_ROWS = 2000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, through Spark's own file systems."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    A session on one machine (tests, a laptop) that names none gets a temporary folder; on a
    cluster that would be a folder of the driver's own, so a session there must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (spark.conf.get("spark.master", None) or "").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="changeloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder as Parquet and read it again.

    Cuts the lineage durably: the files outlive any executor, and later stages
    recompute nothing above this point.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows, unless the session names a number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_ROWS)


def fold_of(key: Column, modulus: int) -> Column:
    """crc32 of a key's decimal text, modulo `modulus`; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def running_sums(sizes: Column, block: int = 64) -> Column:
    """For each place of an array of longs the sum of all before it. Sums of blocks keep long
    arrays far from quadratic."""
    once = lambda value, then: F.transform(F.array(value), then)[0]
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    count = F.ceil(F.size(sizes) / block).cast("int")
    places = F.filter(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: i < count)
    blocks = F.transform(places, lambda b: F.slice(sizes, b * block + 1, F.lit(block)))
    inside = lambda part, base: F.transform(part, lambda _, i: base + total(F.slice(part, F.lit(1), i)))
    every = lambda parts, totals: F.transform(parts, lambda part, b: once(total(F.slice(totals, F.lit(1), b)), lambda base: inside(part, base)))
    return F.flatten(once(blocks, lambda parts: once(F.transform(parts, total), lambda totals: every(parts, totals))))


def slices(batch, column: str, most_bytes: int = 16 << 20):
    """An Arrow batch in slices of about `most_bytes` of one string or binary column.

    A batch is counted in rows, so long values can make it large; work on a slice has
    bounded intermediates. A single longer value is a slice of its own.
    """
    import pyarrow.compute as pc

    if batch.nbytes <= most_bytes or not batch.num_rows:
        yield batch
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start)


def gathered(batches, most_bytes: int):
    """Arrow batches of one schema, small ones joined up to about `most_bytes`."""
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > most_bytes:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def bounded_sample(docs: DataFrame, keep: Column, label: Column, per_label: int, most_bytes: int, id_col: str = "doc_id", text_col: str = "text", labels: DataFrame | None = None, most_labels: int = MOST_LABELS) -> DataFrame:
    """h, id, text, label of a bounded sample, the same on every run.

    Of the rows where `keep` holds, each label gives those with the least hash of their id,
    at most `per_label` ids; of several rows of an id and label the shortest text, then the
    least. Longer texts than `most_bytes` and null ones are left out. All labels are sampled;
    more than `most_labels` raise a ValueError.
    `labels` (id, columns that `label` reads) is joined if given: its rows are few numbers,
    so the sample is drawn from it first and only sampled texts are fetched. The driver sees
    labels and ids, never texts.
    """
    spark = docs.sparkSession
    order = F.xxhash64(F.lit("sample"), F.col("id").cast("string"))
    base = (labels if labels is not None else docs).withColumn("id", F.col(id_col))
    base = base.filter(keep).select("id", label.alias("label")).filter("id is not null and label is not null")
    kinds = sorted(r.label for r in base.select("label").distinct().limit(most_labels + 1).collect())
    if len(kinds) > most_labels:
        raise ValueError(f"more than {most_labels} labels to learn (most_labels)")
    ids: list = []
    for kind in kinds:
        ids += [(r.id, kind) for r in base.filter(F.col("label") == F.lit(kind)).select("id", order.alias("h")).distinct().orderBy("h", "id").limit(per_label).collect()]
    wanted = F.broadcast(spark.createDataFrame(ids, f"id {dict(base.dtypes)['id']}, label {dict(base.dtypes)['label']}"))
    texts = (docs if labels is not None else docs.filter(keep)).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *([label.alias("own")] if labels is None else [])
    )
    texts = texts.filter(F.octet_length("text") <= most_bytes).join(wanted, "id")
    if labels is None:
        texts = texts.filter(F.col("own") == F.col("label"))
    # merged where the rows lie, so an id of many rows moves a few texts
    least = texts.groupBy("id", "label").agg(F.min(F.struct(F.octet_length("text").alias("n"), "text")).alias("t"))
    return least.select(order.alias("h"), "id", F.col("t.text").alias("text"), "label")


def train_in_task(sample: DataFrame, train, label_bytes: int):
    """`train` over (text, label) of a bounded sample, in one task; its result comes back.

    Texts come by hash; each label gives at most `label_bytes` bytes of them, a text that
    would pass that is left out. The driver gets the finished model only, and a lost
    executor costs the one task.
    """
    import pickle

    def chosen(batches):
        left: dict = {}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                size = len(text.encode())
                if size <= left.setdefault(label, label_bytes):
                    left[label] -= size
                    yield text, label

    def run(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(chosen(batches)))], pa.binary())], ["model"])

    drop_unused(sample.sparkSession)
    one = sample.repartition(1).sortWithinPartitions("h", "id", "label").select("text", "label")
    made = one.mapInArrow(tidy(run), "model binary").collect()
    # an empty table has no task
    model = pickle.loads(made[0].model) if made else train([])
    del made
    release_memory()
    return model


def release_memory() -> None:
    """Give freed memory back to the system. Python workers are kept for later tasks and the
    driver for later stages, and allocators keep what was freed; beside a full JVM heap that adds up."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def drop_unused(spark: SparkSession) -> None:
    """Let go of what earlier operators broadcast. Spark's cleaner removes a broadcast, from the
    executors too, once the driver's garbage collection has found it unused, which a driver
    that does little may put off for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim_driver(spark)
    release_memory()


def trim_driver(spark: SparkSession) -> str:
    """Have the driver's JVM give back what its allocator keeps of freed native memory (compilers,
    threads, buffers): over a hundred MB after a few operators, beside the heap. What it says of it;
    empty where a JVM has no such command."""
    from py4j.protocol import Py4JError

    gateway, java = spark.sparkContext._gateway, spark.sparkContext._jvm.java
    beans = spark.sparkContext._jvm.javax.management
    with contextlib.suppress(Py4JError):
        # by reflection on the interface, as the server's own class is not exported
        kinds, given = gateway.new_array(java.lang.Class, 4), gateway.new_array(java.lang.Object, 4)
        for k, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[k] = java.lang.Class.forName(name)
        given[0], given[1] = beans.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke = java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds)
        return invoke.invoke(java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    return ""


def collect_executors(spark: SparkSession) -> None:
    """Have the executors collect their garbage, which also gives free heap back to the system: the
    heap that earlier operators made them take stays theirs otherwise, beside the next one's Python
    workers. A task a core, so that each executor most likely gets one; no result depends on it."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).selectExpr("java_method('java.lang.System', 'gc') AS done").filter("done IS NOT NULL").count()


def tidy(run):
    """`run`, a function over a task's batches, with its memory released at the end."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def apply_batches(docs: DataFrame, id_col: str, text_col: str, fields: str, make) -> DataFrame:
    """id and `fields` for every row: `make()` gives, once a task, a function from a list of
    texts to the columns (lists) of `fields`. Long batches come in slices."""
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = docs.schema[0].dataType.simpleString()
    names = [f.strip().split(" ")[0] for f in fields.split(", ")]

    def run(batches):
        import pyarrow as pa

        work = make()
        for batch in batches:
            for part in slices(batch, "__text"):
                columns = work(part.column("__text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c) for c in columns)], [id_col, *names])

    return docs.mapInArrow(tidy(run), f"`{id_col}` {kind}, {fields}")


def keep_rows(docs: DataFrame, text_col: str, make) -> DataFrame:
    """The rows of `docs` that `make()`, called once a task, chooses: a function from a list
    of texts to a list of booleans. All columns stay as they are."""
    bound_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        keep = make()
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(keep(part.column(text_col).to_pylist()), pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
