import os
import tempfile

from tagmeans.__main__ import main


def test_cli_prints_report(spark, capsys):
    d = tempfile.mkdtemp(prefix="tagmeans-cli-")
    path = os.path.join(d, "postings.csv")
    lines = []
    pid = 1000
    for lang_idx, lang in enumerate(["A", "B"]):
        for q in range(6):
            qid = lang_idx * 100 + q + 1
            lines.append(f"1,{qid},,,0,{lang}")
            for s in range(q % 3 + 1):
                lines.append(f"2,{pid},,{qid},{q * 10 + s}")
                pid += 1
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    main([path, "--langs", "A,B", "--kernels", "4"])
    out = capsys.readouterr().out
    assert "Resulting clusters:" in out
    rows = [ln for ln in out.splitlines() if "%)" in ln]
    assert rows and sum(int(ln.split()[-1]) for ln in rows) == 12


def test_cli_reads_ids_of_64_bits(spark, capsys, tmp_path):
    big = 5_000_000_000
    lines = [f"1,{big + q},,,0,{'AB'[q % 2]}" for q in range(12)]
    lines += [f"2,{2 * big + q},,{big + q},{q}" for q in range(12)]
    path = tmp_path / "postings.csv"
    path.write_text("\n".join(lines) + "\n")
    main([str(path), "--langs", "A,B", "--kernels", "4", "--id-type", "bigint"])
    rows = [ln for ln in capsys.readouterr().out.splitlines() if "%)" in ln]
    assert sum(int(ln.split()[-1]) for ln in rows) == 12
