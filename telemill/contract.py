"""The served data contract: names, order and passthrough columns.

A contract column either renames one lake column or is a typed NULL. For the
parsed JDL table the lake column follows from the naming rule, so the mapping is
computed and only the names are stated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.functions.jdl import OTHER
from telemill.functions.names import PREFIX, jdl_column

# --- Fixed values: the contract's column names, in contract order -----------------
JOB_INFO_NAMES = """
job_id jdl_set trace_set status job_submit_timestamp last_update site
""".split()

TRACE_NAMES = """
job_id aliencpuefficiency cputime host maxrss cpuefficiency finaltimestamp masterjobid pid
requestedcpus requestedttl runningtimestamp savingtimestamp startedtimestamp walltime maxvirt
site laststatuschangetimestamp
""".split()

JDL_KEYS = """
Activity Arguments CPUCores CPULimit CollisionSystem DataframeSize DirectAccess Executable
FilesToCheck HYJobID HYRun HYTrain HardBins InputData InputDataList InputDataListFormat
InputDataType InputFile IterationTimestamp JDLArguments JDLPath JDLProcessor JDLVariables JobTag
LPMActivity LPMAnchorPassName LPMAnchorProduction LPMAnchorRun LPMAnchorYear LPMChainID
LPMCollectionEntity LPMHighPriority LPMInteractionType LPMJobTypeID LPMMaxResubmissions LPMMetaData
LPMParentPID LPMProductionTag LPMProductionType LPMRunNumber LegoResubmitZombies MCAnchor
MasterJobID MasterResubmitThreshold MaxFailFraction MaxOutputSize MaxResubmitFraction
MaxWaitingTime MemorySize OrigRequirements Output OutputDir OutputErrorE OutputFileType PWG
Packages Price Requirements SeNumber Splitted TTL Type User ValidationCommand WorkDirectorySize
LPMPassName
""".split()

# Contract keys that no live column serves: typed NULL.
UNSERVED_KEYS = ("HardBins", "MasterResubmitThreshold")

# Columns outside the contract that the view passes through, in view order.
BOOKKEEPING = """
lpmjobtypeid full_jdl jdl_parse_ok full_jdl_raw _dlt_load_id _dlt_id
""".split()

EXTRA_JDL = """
addtimeseriesinmc anchor_sim_options aodfilesize doemccalib dotpcresidualextraction
dplreportprocessing enablemonitoring enablepermilfulltrackqc enableunbinnedtimeseries
estimated_throughput extracttimeseries forced_kill_timeout hy_train_type hyx_run_merge_id
initial_ttl keep_logs keeptofmatchoutput lpm_anchored_pass_number lpm_pass lpm_production_cycle
lpm_raw_pass lpmc_pass_mode lpmraw_pass_id merging_stage nkeep notfdelay o2_dpg_async_reco_tag
proxy_ttl run3_chunk runanalysisqc split_max_input_file_number subjob_count thinaods
tpcscalingsource trackqcfraction ttl_optimization_type ttl_scaling usethrottling
""".split()

# Known on any lake table without being part of a contract.
LOAD_COLUMNS = ("_dlt_load_id", "_dlt_id")
HELPER_COLUMNS = ("jdl_parse_ok", "full_jdl_raw", "full_jdl")
# --- End of fixed values ----------------------------------------------------------

EXTRA_COLUMNS = tuple(BOOKKEEPING) + tuple(PREFIX + name for name in EXTRA_JDL)


@dataclass(frozen=True)
class ContractTable:
    """One served table: contract name -> lake column (``None`` = typed NULL)."""

    name: str
    columns: dict[str, str | None]
    passthrough: tuple[str, ...] = ()
    null_type: str = "string"

    @property
    def selected(self) -> list[str]:
        """Lake columns the view reads; each must exist."""
        return [source for source in self.columns.values() if source] + list(self.passthrough)

    @property
    def known(self) -> set[str]:
        return set(self.selected) | set(LOAD_COLUMNS) | set(HELPER_COLUMNS) | {OTHER}


JOB_INFO = ContractTable("job_info", {name: name for name in JOB_INFO_NAMES})
TRACE = ContractTable("trace", {name: name for name in TRACE_NAMES})
MON_JDLS_PARSED = ContractTable(
    "mon_jdls_parsed",
    {"job_id": "job_id"}
    | {key: None if key in UNSERVED_KEYS else jdl_column(key) for key in JDL_KEYS},
    EXTRA_COLUMNS,
)
TABLES = {table.name: table for table in (JOB_INFO, TRACE, MON_JDLS_PARSED)}


def _export_name(name: str, taken: set[str]) -> str:
    """A passthrough name that differs from a contract name only in case is prefixed."""
    return f"_src_{name}" if name.lower() in taken else name


def view_columns(table: ContractTable) -> list[tuple[str, str | None]]:
    """(view column, lake column or None) in the order of the view."""
    taken = {name.lower() for name in table.columns}
    return [*table.columns.items(), *((_export_name(name, taken), name) for name in table.passthrough)]


def project(df: DataFrame, table: ContractTable) -> DataFrame:
    """The contract view of a lake table: renamed, ordered, NULLs typed, tail appended."""
    if not table.columns and not table.passthrough:
        raise ValueError(f"{table.name}: nothing to select")
    return df.select(
        *[
            (F.col(source) if source else F.lit(None).cast(table.null_type)).alias(name)
            for name, source in view_columns(table)
        ]
    )
