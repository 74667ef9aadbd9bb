"""The command line runs each promotion step against one folder."""

import contextlib
import io

from sluice.cli import main


def run(*args):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        main(list(args))
    return buf.getvalue()


def test_cli_steps(spark, workdir):
    assert "P0003" in run("check", "--root", workdir)
    out = run("generate", "--root", workdir)
    assert "patients: 101 rows" in out
    assert "Total rows: 101" in run("read-patients", "--root", workdir)
    assert "birth_year" in run("profile", "--root", workdir)
    assert "visits: 251 rows" in run("landing-to-raw", "--root", workdir, "--parallel", "2")
    out = run("clean", "visits", "--root", workdir, "--preview")
    assert "Rows before dedup: 251" in out and "Rows after dedup: 250" in out
    for name in ("patients", "adverse_events", "lab_results", "medications"):
        run("clean", name, "--root", workdir)
    out = run("integrity", "--root", workdir)
    assert "INVALID_FOREIGN_KEY" in out and "V00008" in out
    assert "medications: landing 181, cleaned 180" in run("run-all", "--root", workdir, "--parallel", "5")
