import pytest

from crawlmeta import cli


def parse(*argv):
    return cli.parser().parse_args(list(argv))


def test_modes_and_defaults():
    a = parse("download-sitemaps", "in", "out")
    assert (a.download_connect_timeout_seconds, a.download_read_timeout_seconds, a.download_delay_seconds,
            a.max_depth) == (10, 30, 1, 20)
    a = parse("robots", "m.paths.gz", "out", "--max-files", "3", "--skip-files", "2", "--staging", "s")
    assert (a.max_files, a.skip_files) == (3, 2)
    a = parse("country-sitemaps", "in", "out", "--country", "ukraine", "--suffixes", "s.tsv")
    assert a.country == "ukraine"


@pytest.mark.parametrize("argv", [
    ["robots", "in", "out", "--max-files", "0"],
    ["robots", "in", "out", "--skip-files", "-1"],
    ["sitemaps", "in", "out", "--max-files", "x"],
    ["download-sitemaps", "in", "out", "--download-connect-timeout-seconds", "0"],
    ["download-sitemaps", "in", "out", "--download-delay-seconds", "-1"],
    ["local-sitemaps", "in", "out", "--max-files", "2"],
    ["filter-sitemaps", "in", "out"],
    ["country-sitemaps", "in", "out", "--suffixes", "s.tsv"],
    ["unknown-mode", "in", "out"],
])
def test_rejected_options(argv):
    with pytest.raises(SystemExit):
        parse(*argv)


def test_cli_runs_a_job(tmp_path):
    import json
    import os
    import subprocess
    import sys
    tree = tmp_path / "robots" / "example.ua"
    tree.mkdir(parents=True)
    (tree / "https-1.txt").write_text("User-agent: *\nSitemap: https://example.ua/uk/sitemap.xml\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=root + os.pathsep + os.environ.get("PYTHONPATH", ""))
    out = subprocess.run([sys.executable, "-m", "crawlmeta", "local-sitemaps", str(tmp_path / "robots"),
                          str(tmp_path / "out"), "--master", "local[2]"], capture_output=True, text=True, env=env,
                         cwd=str(tmp_path), timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert json.loads(out.stdout.strip().splitlines()[-1]) == {"parsed_files": 1, "rejected_files": 0}
    lines = [line for p in (tmp_path / "out").glob("part-*") for line in p.read_text().splitlines()]
    assert [line.split("\t")[1:] for line in lines] == [["example.ua", "https", "https://example.ua/uk/sitemap.xml"]]


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="robots_sitemaps,kafka_payload")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], capture_output=True, text=True, env=env,
                         cwd="/tmp", timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = out.stdout.strip().splitlines()
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "total_query_seconds" and d["unit"] == "sec" and set(d["queries"]) == {
        "robots_sitemaps", "kafka_payload"} and d["sf"] == "0.001"
