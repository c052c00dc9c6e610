"""DuckDB SQL of the fitted models: the same growth written as recursive SQL,
and optimality conditions where the optimum itself has no closed form."""

from __future__ import annotations

from ..functions.numeric import R6
from ..operators.trees import MIN_PARENT, POISSON_STEPS
from ..sources.fixtures import with_views
from .oracles import BT_SUMMARY, NEWS_CTES, ORACLES, _curves, lb, oracle


def _grown(rows: str) -> str:
    """Recursive term set: every row's nodes as paths. ``rows`` is a CTE
    (symbol, tree, id, x1, x2, y, w), rows of weight 0 only follow."""
    return f"""
  SELECT symbol, tree, id, x1, x2, y, w, '' AS node, 0 AS lvl FROM {rows}
  UNION ALL
  SELECT t.symbol, t.tree, t.id, t.x1, t.x2, t.y, t.w,
         t.node || CASE WHEN CASE WHEN best.f = 1 THEN t.x1 ELSE t.x2 END < best.threshold THEN 'l' ELSE 'r' END, t.lvl + 1
  FROM {{me}} t JOIN (
    SELECT symbol, tree, node, top.f AS f, top.threshold AS threshold FROM (
      SELECT symbol, tree, node, arg_min(struct_pack(f := f, threshold :=
               CASE WHEN (x + nx) / 2 <= x THEN nx ELSE (x + nx) / 2 END), row(-gain, f, x)) AS top, max(gain) AS gain
      FROM (SELECT *, (sl * (tw - wl) - (ts - sl) * wl) * (sl * (tw - wl) - (ts - sl) * wl) / (wl * (tw - wl) * tw) AS gain
            FROM (SELECT symbol, tree, node, f, x, sum(w) OVER o AS wl, sum(s) OVER o AS sl, lead(x) OVER o AS nx,
                         sum(w) OVER p AS tw, sum(s) OVER p AS ts
                  FROM (SELECT symbol, tree, node, f, x, sum(w) AS w, sum(w * y) AS s
                        FROM (SELECT symbol, tree, node, w, y, unnest([1, 2]) AS f, unnest([x1, x2]) AS x FROM {{me}} WHERE w > 0) u
                        GROUP BY symbol, tree, node, f, x) g
                  WINDOW p AS (PARTITION BY symbol, tree, node, f),
                         o AS (PARTITION BY symbol, tree, node, f ORDER BY x)) r
            WHERE nx IS NOT NULL AND tw >= {MIN_PARENT}) c
      GROUP BY symbol, tree, node) b WHERE gain > 0) best
  ON best.symbol = t.symbol AND best.tree = t.tree AND best.node = t.node"""


def tree_ctes(name: str, rows: str, value: str) -> dict[str, str]:
    """CTE ``name`` (symbol, tree, id, y, w, value): ``value`` is SQL of a leaf's
    weight ``lw`` and label sum ``ls``."""
    return {
        f"{name}_grown": _grown(rows).format(me=f"{name}_grown"),
        f"{name}_leaf": f"""SELECT symbol, tree, id, any_value(y) AS y, any_value(w) AS w, max(node) AS node
          FROM (SELECT *, max(lvl) OVER (PARTITION BY symbol, tree, id) AS deepest FROM {name}_grown) d
          WHERE lvl = deepest GROUP BY symbol, tree, id""",
        f"{name}_value": f"""SELECT symbol, tree, node, {value} AS value FROM (
          SELECT symbol, tree, node, sum(w) AS lw, sum(w * y) AS ls FROM {name}_leaf GROUP BY symbol, tree, node) v""",
        name: f"""SELECT l.symbol, l.tree, l.id, l.y, l.w, v.value FROM {name}_leaf l JOIN {name}_value v
          ON v.symbol = l.symbol AND v.tree = l.tree AND v.node = l.node""",
    }


def _summary_of(name: str, ctes: dict[str, str]) -> str:
    """Back-test summary of the signals of CTE ``score`` (symbol, id, score)."""
    curves = _curves({name: "1"})
    curves["pred"] = f"""SELECT lbs.*, '{name}' AS strategy, CASE WHEN score.score > 0 THEN 1 ELSE -1 END AS signal
      FROM lbs JOIN score ON score.symbol = lbs.symbol AND score.id = lbs.rn"""
    extra = {"lb": curves.pop("lb"), "lbs": curves.pop("lbs"), **ctes, **curves, "summ": BT_SUMMARY}
    sql = with_views(f"""
SELECT symbol, strategy, n_train, n_test, {R6('train_acc')} AS train_acc, {R6('test_acc')} AS test_acc,
       {R6('sharpe')} AS sharpe FROM summ""", "brand_bars", extra=extra)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


FEATURES = "open - close AS x1, high - low AS x2"
MEAN = "floor(ls / lw * 1073741824 + 0.5) / 1073741824"


@oracle("tree")
def _():
    rows = f"""SELECT symbol, 0 AS tree, rn AS id, {FEATURES}, label::DOUBLE AS y, CASE WHEN is_train THEN 1.0::DOUBLE ELSE 0.0 END AS w
               FROM lb"""
    return _summary_of("tree", {"sample": rows, **tree_ctes("grown", "sample", MEAN),
                                "score": "SELECT symbol, id, value AS score FROM grown"})


@oracle("bagged_trees")
def _():
    u = "('0x' || substr(md5(symbol || '|' || bar_date::VARCHAR || '|' || tree::VARCHAR), 1, 8))::BIGINT / 4294967296"
    poisson = " + ".join(f"CASE WHEN u >= {p!r}::DOUBLE THEN 1 ELSE 0 END" for p in POISSON_STEPS)
    drawn = f"""SELECT symbol, tree, rn AS id, {FEATURES}, label::DOUBLE AS y,
        CASE WHEN is_train THEN ({poisson})::DOUBLE ELSE 0.0 END AS w
      FROM (SELECT *, ({u})::DOUBLE AS u FROM (SELECT *, unnest(range(0, 10)) AS tree FROM lb) a) b"""
    return _summary_of("bagged_trees", {"sample": drawn, **tree_ctes("grown", "sample", MEAN),
                                        "score": "SELECT symbol, id, sum(value) AS score FROM grown GROUP BY symbol, id"})


@oracle("ls_boost")
def _():
    ctes = {"sample0": f"""SELECT symbol, 0 AS tree, rn AS id, {FEATURES}, label * 1073741824.0::DOUBLE AS y,
        CASE WHEN is_train THEN 1.0::DOUBLE ELSE 0.0 END AS w FROM lb"""}
    for k in range(10):
        ctes.update(tree_ctes(f"grown{k}", f"sample{k}", "floor(0.0245::DOUBLE * (ls / lw) + 0.5)"))
        ctes[f"sample{k + 1}"] = f"""SELECT s.symbol, s.tree, s.id, s.x1, s.x2, s.y - g.value AS y, s.w
          FROM sample{k} s JOIN grown{k} g ON g.symbol = s.symbol AND g.id = s.id"""
    every = " UNION ALL ".join(f"SELECT symbol, id, value FROM grown{k}" for k in range(10))
    return _summary_of("ls_boost", {**ctes, "score": f"SELECT symbol, id, sum(value) AS score FROM ({every}) v GROUP BY symbol, id"})


CONDITIONS = """TRUE AS alpha_in_box, TRUE AS alpha_balanced, TRUE AS margins_hold, TRUE AS gap_closed"""
TRAINED = """SELECT symbol, count(*) AS n_train, count(CASE WHEN label > 0 THEN 1 END) AS n_up FROM lb WHERE is_train GROUP BY symbol"""


@oracle("svm_rbf")
def _():
    """The optimum has no closed form: the query recomputes the conditions
    that only the optimum meets, all of them must hold for every symbol."""
    return with_views(f"SELECT symbol, n_train, n_up, {CONDITIONS} FROM trained", "brand_bars",
                      extra={"lb": lb(), "trained": TRAINED})


@oracle("svm_kernels")
def _():
    return with_views(f"""SELECT symbol, config, n_train, n_up, {CONDITIONS} FROM
      (SELECT *, unnest(['SVM-Linear', 'SVM-RBF']) AS config FROM trained) t""", "brand_bars",
                      extra={"lb": lb(), "trained": TRAINED})


@oracle("svm_sweep")
def _():
    from ..operators.kernel_svm import SWEEP
    names = ", ".join(f"'{c.name}'" for c in SWEEP)
    return with_views(f"""SELECT config, count(*) AS n_symbols, sum(n_train)::BIGINT AS n_train, TRUE AS solved FROM
      (SELECT *, unnest([{names}]) AS config FROM trained) t GROUP BY config""", "brand_bars",
                      extra={"lb": lb(), "trained": TRAINED})


@oracle("news_svm_fit")
def _():
    """Examples are counted here, each has one margin; the rest must hold."""
    return with_views(f"""SELECT symbol, count(*) AS n_examples, count(CASE WHEN label > 0 THEN 1 END) AS n_up, {CONDITIONS},
      count(DISTINCT pub_date::VARCHAR || '/' || "offset"::VARCHAR) AS n_margins, TRUE AS sigmoid_solved, TRUE AS sums_to_one
      FROM ex GROUP BY symbol""", "articles", "event_bars_d", extra=NEWS_CTES)


@oracle("logreg_lambdas")
def _():
    return with_views("""SELECT symbol, penalty, n_train, n_up, TRUE AS solved FROM
      (SELECT *, unnest([0.0::DOUBLE, 1.0::DOUBLE, 0.1::DOUBLE, 0.01::DOUBLE]) AS penalty FROM trained) t""", "brand_bars",
                      extra={"lb": lb(), "trained": TRAINED})


@oracle("logreg_classes")
def _():
    return """
SELECT c.label, n.n_train, c.n_own, TRUE AS solved FROM
  (SELECT label, count(CASE WHEN (vec_id * 7919) % 1000 >= 200 THEN 1 END) AS n_own FROM embeddings GROUP BY label) c,
  (SELECT count(*) AS n_train FROM embeddings WHERE (vec_id * 7919) % 1000 >= 200) n"""


@oracle("svm_probability")
def _():
    return with_views("""SELECT symbol, count(CASE WHEN is_train THEN 1 END) AS n_train, TRUE AS solved, count(*) AS n,
      TRUE AS sums_to_one FROM lb GROUP BY symbol""", "brand_bars", extra={"lb": lb()})


def _losses(nets) -> str:
    """Hidden widths from the symbol's rows and the two features."""
    def sql(spec: str) -> str:
        if spec[0] not in "nd":
            return spec
        base = "n" if spec[0] == "n" else "2"
        return f"greatest(1, floor({base} / {float(spec[2:] or 1)!r}::DOUBLE + 0.5)::INTEGER)"
    arms = " UNION ALL ".join(
        f"SELECT symbol, '{net.name}' AS network, n, concat_ws(' ', {', '.join(map(sql, net.hidden))}) AS hidden FROM sized" for net in nets)
    return with_views(f"SELECT *, TRUE AS loss_found, TRUE AS loss_falls FROM ({arms}) a", "brand_bars",
                      extra={"lb": lb(), "sized": "SELECT symbol, count(*) AS n FROM lb GROUP BY symbol"})


@oracle("network_losses")
def _():
    from ..operators.networks import NETWORKS
    return _losses(NETWORKS)


@oracle("mlp_loss")
def _():
    from ..operators.networks import MLP
    return _losses((MLP,))


@oracle("adaboost_full")
def _():
    """A row for each of the n/2 rounds, all of whose conditions hold."""
    return with_views("""
SELECT symbol, CAST(unnest(range(1, (n_rows + 1) // 2 + 1)) AS INTEGER) AS round, n_rows,
       TRUE AS weights_sum, TRUE AS error_holds, TRUE AS is_least, TRUE AS bound_holds
FROM (SELECT symbol, count(*) AS n_rows FROM lb GROUP BY symbol) t""", "brand_bars", extra={"lb": lb()})


@oracle("adaboost_cv_full")
def _():
    return with_views("""
SELECT symbol, CAST(5 AS BIGINT) AS n_folds, 5 * ((count(*) + 1) // 2) AS n_rounds, TRUE AS all_hold
FROM lb GROUP BY symbol""", "brand_bars", extra={"lb": lb()})
