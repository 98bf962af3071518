from .chain import Step, chain_counts, chain_results, join_chain
from .tables import Generated, correlated_pair, generate, generate_table, next_table
from .jobs import chain_job, run_chain_job
from .verify import Verification, check_job, verify

__all__ = [
    "Generated",
    "Step",
    "Verification",
    "chain_counts",
    "chain_job",
    "chain_results",
    "check_job",
    "correlated_pair",
    "generate",
    "generate_table",
    "join_chain",
    "next_table",
    "run_chain_job",
    "verify",
]
