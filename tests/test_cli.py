import fixtures as fx
from given import SF_SMALL
from layerloom.__main__ import main


def test_steps_in_order(spark, tmp_path, monkeypatch, capsys):
    raw = tmp_path / "raw"
    posts = fx.posts(spark, SF_SMALL)
    for year in (1997, 1998):
        posts.where(f"year(CreationDate) = {year}").write.parquet(f"{raw}/posts/{year}.parquet")
    fx.users(spark, SF_SMALL).write.parquet(f"{raw}/users.parquet")
    monkeypatch.setenv("WAREHOUSE", str(tmp_path / "w"))
    monkeypatch.setenv("BRONZE_YEAR", "1997,1998")
    monkeypatch.delenv("BRONZE_LIMIT", raising=False)
    main(["ingest-posts", "--source", f"{raw}/posts/{{year}}.parquet"])
    main(["ingest-users", "--source", f"{raw}/users.parquet", "--narrow"])
    main(["list-bronze"])
    for step in ("rebuild-posts", "build-users", "build-gold", "build-users", "build-gold"):
        main([step])
    try:
        users = spark.table("silver.users_hist")
        assert users.count() == fx.users(spark, SF_SMALL).where(
            "CreationDate LIKE '1997%' OR CreationDate LIKE '1998%'"
        ).count()
        owners = posts.where("year(CreationDate) IN (1997, 1998) AND OwnerUserId IS NOT NULL")
        assert spark.table("gold.post_counts_by_user").count() == owners.select("OwnerUserId").distinct().count()
        capsys.readouterr()
        main(["audit"])
        main(["top-owners"])
        shown = capsys.readouterr().out
        assert "gold.post_counts_by_user" in shown and "total_posts" in shown
    finally:
        for name in ("silver.posts_hist", "silver.users_hist", "gold.post_counts_by_user"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
