"""Page, answer, ledger and registry relations derived from the driver tables.

The tables hold no exam pages, so the queries run over relations derived by
rule, each as one SQL text that both Spark and DuckDB read; where the two
differ the text has a macro.  `Fixtures` gives them as DataFrames, `ctes` as
the head of an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NL = "chr(10)"


class Dialect:
    def __init__(self, spark: bool):
        self.spark = spark

    def map_lines(self, text: str, body: str) -> str:
        """Lines of `text` mapped by `body` (x the line, i its number from 1) and joined again."""
        if self.spark:
            return f"array_join(transform(split({text}, {NL}), (x, i0) -> {body.replace('#i', '(i0 + 1)')}), {NL})"
        return f"array_to_string(list_transform(string_split({text}, {NL}), lambda x, i0: {body.replace('#i', 'i0')}), {NL})"

    def map_range(self, n: str, body: str) -> str:
        """Texts `body` for i in 1..n, joined by line ends."""
        if self.spark:
            return f"array_join(transform(sequence(1, {n}), i0 -> {body.replace('#i', 'i0')}), {NL})"
        return f"array_to_string(list_transform(generate_series(1, {n}), lambda i0: {body.replace('#i', 'i0')}), {NL})"

    def each(self, relation: str, n: str, columns: str) -> str:
        """Rows of `relation` for each i in 1..n."""
        if self.spark:
            return f"select {columns} from (select *, explode(sequence(1, cast({n} as int))) as i from {relation})"
        return f"select {columns} from (select *, unnest(generate_series(1, cast({n} as int))) as i from {relation})"

    def sha(self, text: str) -> str:
        return f"sha2({text}, 256)" if self.spark else f"sha256({text})"

    def size(self, text: str) -> str:
        return f"octet_length({text})" if self.spark else f"octet_length(encode({text}))"

    def host(self, url: str) -> str:
        return f"regexp_extract({url}, '^[^:]+://([^/?#]*)', 1)"


def relations(spark: bool) -> dict[str, str]:
    """Name -> SQL; each may read the driver tables and the relations before it."""
    d = Dialect(spark)
    letter = "substring('ABCD', cast((doc_id + #i) % 4 + 1 as int), 1)"
    exam = d.map_lines("text", f"""case (#i - 1) % 5
        when 0 then case when doc_id % 7 = 0 then concat(cast(floor((#i - 1) / 5.0) + 1 as int), {NL}, x) else concat(cast(floor((#i - 1) / 5.0) + 1 as int), '. ', x) end
        when 1 then concat('A) ', x) when 2 then concat('B) ', x) when 3 then concat('C) ', x)
        else case when doc_id % 11 = 0 then concat('Ans.____', {NL}, x) else x end end""")
    entry = d.map_range("cast(5 + doc_id % 23 as int)", f"""concat('QUESTION ', #i, {NL}, case when (doc_id + #i) % 13 = 0 then 'See the explanation on the next page.'
        when (doc_id + #i) % 9 = 0 then concat('The correct answer is ', #i * 3, '. It follows from the table.')
        when (doc_id + #i) % 2 = 0 then concat('Choice ', {letter}, ' is the best answer because  the passage says so.')
        else concat('The correct answer is choice ', {letter}, '.') end)""")
    answer = f"concat(case doc_id % 4 when 0 then 'READING AND WRITING: MODULE 1' when 1 then 'Reading  and writing : module 2' when 2 then 'MATH: MODULE 1' else 'Answers' end, {NL}, {entry})"
    return {
        "pages_raw": f"""select source as source_id, concat(lang, '-', cast(cast(floor(doc_id / 50) as bigint) as string)) as doc, cast(doc_id % 50 + 1 as bigint) as page_num, doc_id, text,
            case doc_id % 10 when 0 then concat('ANSWER KEY', {NL}, text) when 1 then concat('CONTENTS', {NL}, substring(text, 1, 300)) when 2 then concat('ANSWERS', {NL}, text)
                when 3 then substring(text, 1, 100) when 4 then '' else text end as page_text,
            cast(doc_id % 41 as double) / 1000.0 as ink_ratio, case when doc_id % 2 = 0 then 612.0 else 792.0 end as width_pt, cast(700 as double) as height_pt,
            case lang when 'en' then 'PUBLIC_DOMAIN' when 'fr' then 'CC_BY_SA_ATTRIBUTION_SHAREALIKE' when 'de' then 'RESTRICTED_PERSONAL_USE' else 'SOMETHING_ELSE' end as usage_tag
            from documents""",
        "exam_pages": f"""select source_id, doc, page_num, doc_id, usage_tag, concat('..........', {NL}, {exam}) as page_text,
            case when doc_id % 6 < 4 then 'text' when doc_id % 6 = 4 then 'image' else 'skip' end as route
            from pages_raw""",
        "ocr_words": """select user_id as page, event_id as word_num, case when event_id % 7 = 0 then 2 else 5 end as level,
            case when event_id % 11 = 0 then cast(-1 as double) when value > 100 then cast(100 as double) else value end as conf,
            case when event_id % 13 = 0 then '   ' else event_type end as word from events""",
        "ocr_results": """select source_id, doc, page_num, case doc_id % 5 when 0 then 'good' when 1 then 'fair' when 2 then 'review' else 'empty' end as quality_flag,
            cast(case doc_id % 5 when 0 then 91.5 when 1 then 65.5 when 2 then 41.5 else 0.0 end as double) as mean_conf, cast(doc_id % 97 as bigint) as word_count
            from exam_pages where route = 'image' and doc_id % 9 <> 4""",
        "answer_pages": f"""select cast(floor(doc_id / 2) as bigint) as pair, cast(doc_id % 2 + 1 as int) as page_num, doc_id,
            {answer} as page_text
            from documents""",
        "qa_pages": f"""select concat('s', cast(group_no % 4 as string)) as source_id, case when group_no % 6 = 5 and doc_id % 5 = 4 then 'notes' else concat('sat-practice-test-', cast(group_no as string), case when doc_id % 5 = 4 then '-answers-digital' else '-digital' end) end as doc,
            cast(doc_id % 40 + 1 as bigint) as page_num, doc_id, case when doc_id % 5 = 4 then {answer} else page_text end as page_text, case when doc_id % 5 <> 4 or doc_id % 7 = 0 then 'content' else 'answer_key' end as classification, usage_tag
            from (select doc_id, cast(floor(doc_id / 40) as bigint) as group_no, page_text, usage_tag from exam_pages) t""",
        "align_items": f"""select cast(floor(doc_id / 2) as bigint) as pair, cast(doc_id % 2 * 1000 + i * 2 + k as int) as item_pos,
            concat('p', cast(doc_id as string), ':', cast(i as string), ':', cast(k as string)) as item_id, case when k = 1 then '2' when (doc_id + i) % 19 = 0 then 'IV' else cast(i as string) end as number_label
            from ({d.each("documents", "5 + doc_id % 23", "doc_id, i")}) t cross join (select 0 as k union all select 1 as k) u
            where (k = 0 and (doc_id + i) % 6 <> 0) or (k = 1 and (doc_id + i) % 17 = 0)""",
        "payloads": """select doc_id, case doc_id % 4 when 0 then concat('%PDF-1.4 ', text, text, text, text, text) when 1 then concat('  [1, 2] ', text) when 2 then concat('<!DOCTYPE html> ', text) else text end as payload from documents""",
        "ledger_rows": f"""select {d.host("url")} as source_id, url, {d.sha("html")} as sha256, cast({d.size("html")} as bigint) as size_bytes,
            case page_id % 4 when 0 then 'collected' when 1 then 'skipped' when 2 then 'failed' else 'manual_intake' end as status, concat('data/', cast(page_id as string)) as local_path, page_id, 1 as batch from pages
            union all select {d.host("url")}, url, {d.sha("concat(html, 'x')")}, cast(0 as bigint), 'verified', concat('data/', cast(page_id as string)), page_id, 2 from pages where page_id % 5 = 0""",
        "sources_seed": """select concat('src-', cast(s_suppkey as string)) as id, s_name as name, n_name as publisher, case s_suppkey % 4 when 0 then 'archive' when 1 then 'publisher' when 2 then 'government' else 'community' end as source_type,
            case s_suppkey % 5 when 0 then 'rejected' when 1 then 'conditional' else 'approved' end as status, case when s_suppkey % 3 = 0 then null when s_suppkey % 3 = 1 then 'PUBLIC_DOMAIN' else 'RESTRICTED_PERSONAL_USE' end as usage_tag,
            case when s_suppkey % 7 = 0 then null else concat('p', cast(s_suppkey % 3 as string)) end as priority, concat('Reason ', cast(s_suppkey % 6 as string), '. More words. And more') as decision_reason,
            case s_suppkey % 4 when 0 then 'skip' when 1 then 'direct' when 2 then 'archive_org' else null end as method, s_suppkey % 2 = 0 as owner_signoff, s_suppkey
            from supplier join nation on s_nationkey = n_nationkey""",
    }


TABLES = ("documents", "events", "pages", "supplier", "nation", "orders", "lineitem", "part")


def spread(table: DataFrame) -> DataFrame:
    """A table that comes in fewer splits than there are cores, dealt over the cores: its rows cost far more than their move."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


class Fixtures:
    """The relations as lazy DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._sql = relations(True)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name not in self._sql:
                table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
                self._made[name] = spread(table) if name == "documents" else table
            else:
                text = self._sql[name]
                known = [k for k in (*TABLES, *self._sql) if k != name and _reads(text, k)]
                frames = {f"r_{k}": self[k] for k in known}
                for k in known:
                    text = _swap(text, k)
                self._made[name] = self.spark.sql(text, **frames)
        return self._made[name]


def _reads(text: str, table: str) -> bool:
    import re

    return re.search(rf"\b(from|join)\s+{table}\b", text) is not None


def _swap(text: str, table: str) -> str:
    import re

    return re.sub(rf"\b(from|join)\s+{table}\b", rf"\1 {{r_{table}}}", text)


def ctes(*names: str) -> str:
    """`with` clause of the named relations and what they read, for DuckDB."""
    sql = relations(False)
    need: list[str] = []

    def add(name: str) -> None:
        for k in sql:
            if k != name and _reads(sql[name], k) and k not in need:
                add(k)
        if name not in need:
            need.append(name)

    for n in names:
        add(n)
    return "with " + ", ".join(f"{n} as ({sql[n]})" for n in need)
