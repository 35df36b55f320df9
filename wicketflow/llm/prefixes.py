"""A trie of rebuilt conversations from composable fingerprints of their turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wicketflow.llm.scan import Law, running
from wicketflow.session import stage

#: Conversations of a family, whose first one gives the head.
FAMILY = 100
#: A head has fewer turns than this.
HEADS = 6
#: Primes below 2^31, so that products stay within a long.
MODULI = (2147483647, 2147483629, 2147483587, 2147483579)
#: Bases of the fingerprints; the next row is taken if a group shows a collision.
BASES = ((1103515245, 1299709, 69621, 48271), (742938285, 950706376, 1226874159, 62089911))
#: Conversations whose ids are joined to one text before they are hashed.
TOGETHER = 1024
_F = ("f0", "f1", "f2", "f3")

NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256")


def turns(df: DataFrame, laws: dict[str, Law], conv: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text") -> DataFrame:
    """Turns in their order: conv, place, size, ref and the prefix's fingerprint f0..f3.

    A turn is known by the SHA-256 of role and text: one half of it gives the four numbers that
    the fingerprint adds up, 64 other bits are the stored reference. Turns of equal number
    stand in order of the hash.
    """
    who, said = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    known = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.length(said).cast("long").alias("size"),
        F.unhex(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said), 256))
        .alias("sha"))
    kind = known.schema["turn"].dataType
    moduli = [law.modulus for law in laws.values()]

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha = np.frombuffer(b"".join(batch.column("sha").to_pylist()), np.uint8)
            words = sha.reshape(-1, 32)
            digits = np.ascontiguousarray(words[:, :16]).view("<u4").astype(np.int64)
            refs = np.ascontiguousarray(words[:, 16:24]).view("<i8")[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("turn"), batch.column("size"),
                 pa.array(refs)] + [pa.array(digits[:, i] % p) for i, p in enumerate(moduli)],
                names=["conv", "turn", "size", "ref", *_F])

    schema = T.StructType([T.StructField("conv", T.LongType()), T.StructField("turn", kind)]
                          + [T.StructField(c, T.LongType()) for c in ("size", "ref", *_F)])
    order = [F.col("turn").asc_nulls_first(), F.col("ref"), *map(F.col, _F)]
    return running(known.mapInArrow(split, schema), "conv", order, laws, "turns").drop("turn")


def head_length(conv: Column) -> Column:
    return F.crc32(conv.cast("string")) % HEADS


def heads_and_suffixes(told: DataFrame, laws: dict[str, Law]) -> DataFrame:
    """For each conversation the head's turns and how its own fingerprints continue them.

    Columns: conv, h, k (turns of the head), total (turns rebuilt), head, and add, times for
    each fingerprint: a rebuilt prefix that ends with an own turn of fingerprint f has
    add + times * f. The own head's product is taken off and the other head's put before it,
    without a look at any text.
    """
    own = told.groupBy("conv").agg(
        F.max("place").alias("n"),
        *[F.max(F.when(F.col("place") == head_length(F.col("conv")), F.col(c))).alias(c)
          for c in laws])
    heads = (told.where((F.col("conv") % FAMILY == 0) & (F.col("place") < HEADS))
             .groupBy(F.col("conv").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("place", *laws, "ref", "size")))
                  .alias("head")))
    own = own.withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    h, k = F.col("h"), F.col("k")
    both = (own.join(heads, "base", "left").withColumn("h", head_length(F.col("conv")))
            .withColumn("k", F.least(h, F.coalesce(F.size("head"), F.lit(0)).cast("long"))))
    moved = {}
    for c, law in laws.items():
        factors = F.array(*[F.lit(pow(law.base, a - b, law.modulus)) for a in range(HEADS)
                            for b in range(HEADS)])
        before = F.when(k > 0, F.try_element_at("head", k.cast("int"))[c]).otherwise(0)
        times = F.element_at(factors, (k * HEADS + h + 1).cast("int"))
        taken = (law.modulus - F.coalesce(c, F.lit(0))) % law.modulus
        moved[f"add_{c}"] = (before + times * taken) % law.modulus
        moved[f"times_{c}"] = times
    moved["total"] = k + F.greatest(F.col("n") - h, F.lit(0))
    return both.withColumns(moved).select("conv", "h", "k", "total", "head", *[
        f"{what}_{c}" for c in laws for what in ("add", "times")])


def prefixes(told: DataFrame, convs: DataFrame, laws: dict[str, Law]) -> DataFrame:
    """conv, depth, a, b (the fingerprint), ref, size, last for each rebuilt prefix, root aside."""
    head = (convs.where("k > 0").select("conv", "total", F.inline(F.expr("slice(head, 1, k)")))
            .withColumnRenamed("place", "depth"))
    own = told.where(F.col("place") > head_length(F.col("conv"))).join(
        convs.drop("head"), "conv")
    own = own.select("conv", "total", (F.col("k") + F.col("place") - F.col("h")).alias("depth"),
                     *[((F.col(f"add_{c}") + F.col(f"times_{c}") * F.col(c)) % law.modulus)
                       .alias(c) for c, law in laws.items()], "ref", "size")
    return head.unionByName(own).select(
        "conv", "depth", (F.col("f0") * 2 ** 31 + F.col("f1")).alias("a"),
        (F.col("f2") * 2 ** 31 + F.col("f3")).alias("b"), "ref", "size",
        (F.col("depth") == F.col("total")).alias("last"))


def trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
         text: str = "text") -> DataFrame:
    """One row for each node of the trie of rebuilt conversations, with the columns of `NODE`.

    A conversation is rebuilt from the first turns of its family's first conversation and its
    own later turns. A prefix is known by the product of its turns' fingerprints: those of head
    and own suffix are combined as numbers. Each group of equal prefixes is then checked: all
    its last turns must have the same stored reference, which with the fingerprint's law makes
    the prefixes before them equal too; if any differ, the whole is done with other bases.

    The smallest member owns a node. A conversation owns the lower end of its path, so nodes
    form paths that hang on one another; sums over subtrees are a path's own sum, added once
    for each path above it and then run up along every path. No row pairs two conversations.

    Null role or text is empty; a null turn number comes first and equal numbers stand in order
    of the turn's hash, so repeated rows are repeated turns. Rows without a conversation id take
    no part; the remainder of a negative id is negative. An empty table has no node. Other
    columns are not read. Ids that end at a node are joined in blocks and hashed as they stream
    by, so that a large group of copies is never held at once.
    """
    for bases in BASES:
        laws = {c: Law(b, m) for c, b, m in zip(_F, bases, MODULI, strict=True)}
        told = turns(df, laws, conv, turn, role, text)
        convs = stage(heads_and_suffixes(told, laws), "conversations")
        paths = stage(prefixes(told, convs, laws), "prefixes")
        nodes = stage(paths.groupBy("depth", "a", "b").agg(
            F.min("conv").alias("owner"), F.count("*").alias("n"),
            F.count_if("last").alias("ends"), F.min("size").alias("size"),
            F.min("ref").alias("ref"), F.max("ref").alias("other")), "nodes")
        if nodes.where("ref <> other").isEmpty():
            return _with_sums(convs, paths, nodes)
    raise RuntimeError("fingerprints collide for all bases")


def _with_sums(convs: DataFrame, paths: DataFrame, nodes: DataFrame) -> DataFrame:
    every = convs.agg(F.min("conv").alias("owner"), F.count("*").alias("n"),
                      F.count_if(F.col("total") == 0).alias("ends")).collect()[0]
    root = {"owner": F.lit(every.owner).cast("long"), "n": F.lit(every.n),
            "saved": F.lit(0).cast("long"), "leaf": F.lit(int(every.n == every.ends)).cast("long")}
    told = nodes.select("depth", "a", "b", "owner", "n",
                        ((F.col("n") - 1) * F.col("size")).alias("saved"),
                        (F.col("n") == F.col("ends")).cast("long").alias("leaf"))
    along = paths.select("conv", "depth", "a", "b", "last").join(
        told.drop("n"), ["depth", "a", "b"])
    at_root = convs.select("conv", F.lit(0).cast("long").alias("depth"),
                           (F.col("total") == 0).alias("last"),
                           *[root[c].alias(c) for c in ("owner", "saved", "leaf")])
    columns = ["conv", "depth", "last", "owner", "saved", "leaf"]
    along = stage(along.select(*columns).union(at_root.select(*columns)), "owners")

    # For each conversation and each owner along its path: the depths and sums of that stretch.
    stretch = along.groupBy("conv", "owner").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"),
        F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    own, of_conv = F.col("owner") == F.col("conv"), Window.partitionBy("conv")
    hung = (stretch.withColumns({f"own_{c}": F.max(F.when(own, F.col(c))).over(of_conv)
                                 for c in ("top", "saved", "leaf")})
            .where(~own & F.col("own_top").isNotNull())
            .withColumn("direct", F.col("bottom") == F.col("own_top") - 1))
    nothing = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    parts = [
        told.select("owner", "depth", "n", "saved", "leaf", nothing, none),
        convs.sparkSession.range(1 if every.n else 0).select(
            root["owner"], nothing, root["n"], root["saved"], root["leaf"], nothing, none),
        hung.select("owner", "bottom", none, "own_saved", "own_leaf",
                    F.col("direct").cast("long"), none),
        hung.where("direct").select("conv", "own_top", none, nothing, nothing, nothing, "owner")]
    names = ["owner", "depth", "n", "saved", "leaf", "hung", "above"]
    whole = parts[0].toDF(*names)
    for p in parts[1:]:
        whole = whole.union(p.toDF(*names))
    whole = whole.groupBy("owner", "depth").agg(
        F.max("n").alias("n"), F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"),
        F.sum("hung").alias("hung"), F.max("above").alias("above"))
    summed = running(whole, "owner", [F.col("depth").desc()], {"saved": Law(), "leaf": Law()},
                     "subtrees")
    ends = ends_digest(along.where("last").select("owner", "depth", "conv"))
    return summed.join(ends, ["owner", "depth"], "left").select(
        F.col("owner").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.coalesce("above", "owner")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        # Below the deepest node of a path there is none of the same owner.
        (F.col("hung") + (F.col("place") > 1).cast("long")).alias("n_children"),
        F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """owner, depth, sha: of the ids that end at a node, ascending, in decimal, comma-joined."""
    blocks = (ends.groupBy("owner", "depth", F.floor(F.col("conv") / TOGETHER).alias("block"))
              .agg(F.array_sort(F.collect_list("conv")).alias("ids"))
              .select("owner", "depth", "block",
                      F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids")))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("owner", "depth", "ids")]
            for owner, depth, ids in zip(*columns, strict=True):
                if at == (owner, depth):
                    state.update(b",")
                else:
                    if at:
                        done.append((*at, state.hexdigest()))
                    at, state = (owner, depth), hashlib.sha256()
                state.update(ids.encode())
            yield _digests(done)
        if at:
            yield _digests([(*at, state.hexdigest())])

    return (blocks.repartition("owner", "depth")
            .sortWithinPartitions("owner", "depth", "block")
            .mapInArrow(hashed, "owner long, depth long, sha string"))


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    owner, depth, sha = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(owner, pa.int64()), pa.array(depth, pa.int64()), pa.array(sha, pa.string())],
        names=["owner", "depth", "sha"])
