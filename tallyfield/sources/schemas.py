"""Declared schemas of the input tables and the column check made before planning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

EVENT_KEY = ["run_number", "ev_id", "ev_id_ext"]
FILE_ID = "file_id"


def _struct(**groups: Sequence[str]) -> T.StructType:
    kinds = {"long": T.LongType(), "double": T.DoubleType(), "int": T.IntegerType(), "string": T.StringType()}
    return T.StructType([T.StructField(name, kinds[kind]) for kind, names in groups.items() for name in names])


EVENTS = _struct(
    long=EVENT_KEY,
    double=["centrality", "z_vtx_reco", "perc_v0m", "v0m", "v0m_eq", "v0m_corr", "v0m_eq_corr", "n_tracklets",
            "n_tracklets_corr", "z_vtx_gen", "mult_gen", "mult_gen_v0a", "mult_gen_v0c"],
    int=["n_vtx_contributors", "n_tracks", "is_ev_rej", "is_ev_rej_INT7", "trigger_hasbit_INT7",
         "trigger_hasbit_HighMultSPD", "trigger_hasbit_HighMultV0"],
)

CANDIDATES = _struct(
    long=EVENT_KEY,
    int=["cand_type", "spdhits_prong0", "spdhits_prong1"],
    double=["pt_cand", "eta_cand", "phi_cand", "y_cand", "inv_mass", "d_len", "d_len_xy", "norm_dl", "norm_dl_xy",
            "cos_p", "cos_p_xy", "imp_par_xy", "imp_par_prod", "dca", "cos_t_star", "max_norm_d0d0exp", "pt_prong0",
            "pt_prong1", "imp_par_prong0", "imp_par_prong1", "imp_par_err_prong0", "imp_par_err_prong1",
            "nsigTPC_Pi_0", "nsigTPC_K_0", "nsigTPC_Pi_1", "nsigTPC_K_1", "nsigTOF_Pi_0", "nsigTOF_K_0",
            "nsigTOF_Pi_1", "nsigTOF_K_1", "pt_jet", "eta_jet", "phi_jet", "delta_eta_jet", "delta_phi_jet",
            "delta_r_jet", "zg_jet", "rg_jet", "nsd_jet"],
)

GENERATED = _struct(
    long=EVENT_KEY,
    int=["cand_type"],
    double=["pt_cand", "eta_cand", "phi_cand", "y_cand", "pt_jet", "eta_jet", "phi_jet", "delta_eta_jet",
            "delta_phi_jet", "delta_r_jet", "zg_jet", "rg_jet", "nsd_jet"],
)

CURVE = _struct(double=["pt", "central", "min", "max"])
RUN_LIST = T.StructType([T.StructField("list_name", T.StringType()), T.StructField("run_number", T.LongType())])
ERROR_TABLE = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("ibin", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in ("x_low", "x_up", "y_low", "y_up")]
)


def missing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    absent = missing(df, columns)
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df
