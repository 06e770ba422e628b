"""The reference's model families and grids.

Families share work across their grid where the algorithm allows it:
AdaBoost fits 200 rounds once and scores each prefix; kNN finds the 19
nearest rows once and scores every k; SVR fits all (C, epsilon) points in
the same data passes; the linear family comes from one pass of sufficient
statistics. How they are fitted, stored and opened is in ``families``.
"""

from __future__ import annotations

from . import svr as SVR

# The reference's grids.
FOREST_GRID = [{"n_estimators": n, "max_features": f} for f in ("auto", "log2", "sqrt") for n in (100, 500, 1000)]
ADABOOST_GRID = [{"n_estimators": n} for n in (50, 75, 100, 125, 150, 175, 200)]
SVR_GRID = [{"C": c, "epsilon": e} for c in SVR.C_GRID for e in SVR.EPSILON_GRID]
KNN_GRID = [{"n_neighbors": k} for k in range(5, 20)]


def study_grids(with_pca: bool) -> dict:
    """The reference's two study grids: 72 configurations with PCA (all seven
    model kinds), 22 without (least squares, lasso, forest with log2, AdaBoost)."""
    from .grid import linear_grid
    if with_pca:
        return {"linear": linear_grid(), "svr": SVR_GRID, "forest": FOREST_GRID, "adaboost": ADABOOST_GRID,
                "knn": KNN_GRID}
    lin = [g for g in linear_grid() if g[0] in ("linear", "lasso")]
    return {"linear": lin, "forest": [p for p in FOREST_GRID if p["max_features"] == "log2"],
            "adaboost": ADABOOST_GRID}
