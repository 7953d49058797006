"""Inline relations for rules in Chinese, which the driver's tables do not hold."""

QUESTIONS = ("idx long, text string, source_url string", [
    (0, "代餐和节食差在哪里？", "https://a.cn/1"), (1, "减脂好不好？", "https://a.cn/2"), (2, "可能有人问减脂难在哪？", "https://a.cn/3"),
    (3, "这还用说吗减脂就是少吃", "https://a.cn/4"), (4, "减脂吗？", "https://a.cn/5"), (5, "减脂是什么？", ""), (6, "人生的意义是什么？", "https://a.cn/6"),
    (7, "减脂未来会不会更火？", "https://a.cn/7"), (8, "今天吃得很好", "https://a.cn/8"), (9, "怎么减脂才对！", "https://a.cn/9"),
    (10, "　夜班司机减脂期该怎么吃？　", "https://a.cn/10"), (11, "减脂平台期要持续多久呢", "https://a.cn/11"), (12, "哪个减脂动作效果好？", "https://a.cn/12"),
    (13, "每周跑步日程如何安排?", "https://a.cn/13"), (14, "楼下面馆怎么样", "https://a.cn/14"), (15, "减脂吃代餐有没有用", "https://a.cn/15"), (16, "是否？", "https://a.cn/16"),
])
DEDUPE = ("idx long, text string, url string", [
    (0, "减脂是什么？", "u1"), (1, "什么是减脂？", "u2"), (2, "减脂怎么做？", "u3"), (3, "夜班司机减脂期该怎么吃？", "u4"), (4, "减脂怎么吃？", "u5"),
    (5, "减脂是什么?", "u6"), (6, "到底减脂是什么？", "u7"), (7, "fat loss basics", "u8"), (8, "what is a plateau", "u9"), (9, "X吗？", "u10"), (10, "X？", "u11"), (11, "  ", "u12"),
    (12, "平台期持续多久？", "u13"), (13, "减脂平台期一般会持续多久？", "u14"),
])
TITLES = ("idx long, title string", [
    (0, "减脂期间应该怎么睡？ - 知乎"), (1, "“减肥和增肌有什么区别？”"), (2, "你见过胖的长跑冠军吗？"), (3, "还在饿着减肥？"), (4, "减脂打卡送礼品，你心动了吗？"),
    (5, "常见问题：1、减脂平台期怎么办？"), (6, "一、减肥能不能喝咖啡？ | 丁香医生"), (7, "关于我们"), (8, "自动驾驶的未来在哪里？"), (9, "【早报图片】减脂为什么会头晕？"),
    (10, "所以，减脂到底要不要吃碳水呢"), (11, "访问 http://x.com 减肥吗？"), (12, "减脂餐怎么做？ 展开"), (13, ""), (14, "《减肥期间可以喝奶茶吗？》"),
])
RAW = ("idx long, text string", [
    (0, "2023-06-08作者：林小北1、节食、断食和减脂有什么不同？"), (1, "最热内容 · 关于减脂加餐，应该怎么选？"), (2, "深蹲练的是腿     ‼️断食减肥更快？"),
    (3, "**减脂** ### 怎么吃？ 12"), (4, "减肥😀😀怎么办？"), (5, "[减脂怎么做？]"), (6, "来源：新华社，减肥药靠谱吗？"),
])
LINKS = ("idx long, title string, url string, snippet string, action string", [
    (0, "QINGTI·7日轻体原理解析", "https://example.com/qingti", "", "单页采集"), (1, "某教程", "https://item.taobao.com/item.htm?id=1", "", "单页采集"),
    (2, "种菜机代理招商，在家躺赚", "https://example.com/join", "", "单页采集"), (3, "WHO Physical Activity Fact Sheet", "https://www.who.int/news-room/fact-sheets/detail/physical-activity", "", "单页采集"),
    (4, "阳台种菜手册（共九章）", "https://docs.garden.example.com/docs/handbook", None, "整站扒取"), (5, "我家番茄的一年", "https://garden.example.com.au/blog/post-1", "", "单页采集"),
    (6, "知乎专栏", "https://zhuanlan.zhihu.com/p/1", "", "单页采集"), (7, "专栏", "https://www.bilibili.com/read/cv1", "", "opencli"), (8, "手册", "https://example.org/a.pdf", "", "collector"),
    (9, "书", "https://book.douban.com/subject/1", "", "找电子版/购书"), (10, "文档", "https://docs.example.com/", "", "整站扒取"), (11, "论文", "https://pubmed.ncbi.nlm.nih.gov/30112233/", "", ""),
    (12, "论文", "https://pmc.ncbi.nlm.nih.gov/articles/PMC7654321/", "", ""), (13, "好物", "https://post.smzdm.com/p/az8qvv5n", "", ""), (14, "预印本", "https://arxiv.org/abs/2401.00001v2", "", ""),
    (15, "期刊", "https://doi.org/10.1000/ABC", "", ""), (16, "镜像", "https://europepmc.org/article/MED/30112233", "", ""), (17, "code", "https://github.com/a/b", "", ""),
    (18, "share", "HTTPS://X.com/a/?utm_source=tw&utm_medium=social#top", "", ""), (19, "share", "https://x.com/a", "", ""), (20, "odd", "not a url", "", ""), (21, "fake", "https://fedex.com/x", "", ""),
    (22, "gov", "http://www.nhc.gov.cn/a;p=1?b=2&utm_x=3&c=4", "", ""), (23, "新闻", "https://www.sohu.com/a/1", "", ""), (24, "faa", "https://www.faa.gov/", "", ""),
    (25, "mayo", "https://www.mayoclinic.org/x", "", ""), (26, "咖啡减肥真相", "https://example.net/", "", ""), (27, "减脂原理有用吗", "https://example.net/2", "", ""), (28, "baike", "https://baike.baidu.com/item/x", "", ""),
])
SOURCES = ("card string, ord long, name string, url string, original_source_id string, grade string", [
    ("a", 1, "PubMed 1", "https://pubmed.ncbi.nlm.nih.gov/11111111/", "", "high"), ("a", 2, "PubMed 2", "https://pubmed.ncbi.nlm.nih.gov/22222222/", "", "high"),
    ("b", 1, "NHS", "https://www.nhs.uk/a", "", "high"), ("b", 2, "NHS again", "https://nhs.uk/b", "", "high"), ("c", 1, "搜狐", "https://www.sohu.com/a/1", "", "high"),
    ("d", 1, "PubMed", "https://pubmed.ncbi.nlm.nih.gov/33333333/", "", "high"), ("d", 2, "Europe PMC", "https://europepmc.org/article/MED/33333333", "", "high"),
    ("e", 1, "WHO", "https://www.who.int/x", "who-1", "high"), ("e", 2, "blog", "https://blog.example.com/", "who-1", "unknown"), ("f", 1, "L3/notes.md", "", "study-9", "high"),
    ("f", 2, "WHO", "https://www.who.int/y", "", "high"), ("g", 1, "forum", "https://forum.example.com/", "", "unknown"),
])
CARDS = ("card string, has_conflict boolean, state string", [("a", False, "达标"), ("b", False, "达标"), ("c", False, "达标"), ("d", True, "达标"), ("e", False, "待补采"), ("f", False, "达标"), ("g", False, "达标"), ("h", False, "达标")])
FILES = ("path string", [("L3/notes.md",), ("L1/who.md",)])
DOCS = ("doc_id long, text string, title string, tutorial_type string, case_name string, n_materials long", [
    (1, "# 减脂平台期\n\n写给减脂三周的人，读完能判断自己是否进入平台期。\n\n体重连续14天不动，你可能进入了平台期。真的吗？\n\n- 称重\n- 记录\n\n## 怎么判断\n\n1. 连续称重\n2. 取平均\n\n| 天 | 体重 |\n|---|---|\n| 1 | 70 |\n", "减脂平台期", None, "小林", 1),
    (2, "## 步骤\n\n" + "这一定绝对非常十分极其显著。" * 8 + "\n\n#### 跳级\n\n让我们开始。不仅快，而且省。不仅好，更强。", None, "操作型", None, 0),
    (3, "不一定会失败。" + "啊" * 320, None, None, None, 2), (4, "", None, None, None, 0),
    (5, "根据《减脂指南》（2021）研究表明有效。\n素材：L3_补充/a.md、L4/b.md\n取得了长足的进步。不是节食，而是调整。不是饿，是慢。不是快，是稳。首先称重。\n- [ ] 自查", None, "决策型", "小林", 1),
    (6, "### 只有一个\n\n## 甲\n## 乙\n" + "他说好。你说行。" * 30, None, None, None, 0),
])
ESSAYS = ("doc_id long, text string, title string, tutorial_type string", [
    (1, "# 阳台种番茄\n\n开头说的是别的事。\n第二行也没有提到。\n第三行讲了天气。\n第四行讲了邻居。\n第五行讲了一只猫。", None, None),
    (2, "番茄要晒太阳。\n阳台朝南最好。\n浇水别太勤。\n肥料少一点。\n番茄红了就摘。", "第三章 阳台番茄", None),
    (3, "未来的番茄必然更甜。下一步可能会降价，但一定会的事不多。以后阳台肯定会更大！", None, "操作型"),
    (4, "先看叶子。总之要多看。\n\n再看土。“所以别急着浇水\n\n最后看光！由此可见，光最要紧。\n\n## 小结\n\n| 表 | 格 |", None, None),
    (5, "- 甲\n- 乙\n\n\n- 丙\n\n说明一句。\n\n* 丁", None, None), (6, "- 甲\n\n隔了一句话。\n\n- 乙\n  - 丙\n正文", None, None),
    (7, "# 题目\n```text\n- 代码里的列表\n```\n- 甲\n<!-- 注释\n- 里面 -->\n\n    - 缩进的不算\n- 乙\n~~~\n没有关上", None, None), (8, "", "", None), (9, " \n\t\n", None, None),
    (10, "> ```\n> - 引用里的代码\n> ```\n正文在这里。\n`````\n```\n还在里面\n`````\n出来了。", None, None),
])
HARVEST = ("idx long, text string", [(0, None), (1, ""), (2, "Error: rate limit reached, free tier"), (3, "we do not support this site"), (4, "睡眠 quality 日记 note"), (5, "减脂" * 300), (6, "word " * 200), (7, "配额已用完"), (8, "!!!")])
EVIDENCE = ("article string, section string, claim_id string", [("p", "s1", "c1"), ("p", "s1", "c9"), ("p", "s2", "c2"), ("q", "s1", "c1"), ("q", "s3", "c7")])
CLAIMS = ("article string, ord long, claim_id string, statement string, claim_type string", [("p", 1, "c1", "x", "事实"), ("p", 2, "c2", " ", "事实"), ("p", 3, "c2", "y", None), ("q", 1, "c1", "z", "事实"), ("q", 2, "-bad", "z", "事实"), ("q", 3, None, "z", "")])
QUOTES = ("claim_id string, source_id string, quote string", [("c1", "s1", "每周 150 分钟"), ("c2", "s1", "每周 300 分钟"), ("c3", "s2", "蛋白质"), ("c4", "s9", "无")])
SNAPSHOTS = ("source_id string, text string", [("s1", "成人每周 150 分钟中等强度活动"), ("s2", "蛋白质摄入")])
CRITERIA = ("article string, criterion_id string", [("p", "k1"), ("p", "k2"), ("q", "k1")])
CHECKS = ("article string, criterion_id string", [("p", "k1"), ("p", "k1"), ("p", "k3"), ("q", "k1")])
REPORTS = ("report string, version long, n_errors long, error_count long, n_warnings long, warning_count long, status string", [("r1", 3, 0, 0, 1, 1, "minor"), ("r2", 3, 0, 0, 0, 0, "pass"), ("r3", 2, 0, 0, 0, 0, "pass"), ("r4", 3, 1, 1, 0, 0, "fail"), ("r5", 3, 0, 0, 0, 0, "pass"), ("r6", 3, 0, 0, 2, 1, "minor")])
RECORDED = ("report string, path string, sha256 string", [("r1", "/a", "h1"), ("r1", "/b", "h2"), ("r2", "/a", "old"), ("r3", "/a", "h1"), ("r4", "/a", "h1"), ("r5", "/gone", "h9"), ("r6", "/a", "h1")])
CURRENT = ("path string, sha256 string", [("/a", "h1"), ("/b", "h2"), ("/c", "h3")])
REQUIRED = ("report string, path string", [("r1", "/a"), ("r2", "/a")])
ROUNDS = ("topic string, round long, prev_total long, new_count long", [("t", 1, 0, 10), ("t", 2, 10, 6), ("t", 3, 16, 4), ("t", 4, 20, 3), ("t", 5, 23, 2), ("t", 6, 25, 20), ("u", 1, 0, 0), ("u", 2, 0, 5), ("u", 3, 5, 1)])
PREREQUISITES = ("reason string, min_stage string, ok boolean", [("topic gate", "stage3", True), ("answers", "stage4", True), ("outlines", "stage5", False), ("outline gate", "stage5", True), ("drafts", "stage6", False), ("qc", "delivered", False)])
STATUS = ("tutorial string, stage_idx int, stage string, satisfied boolean", [("x", 1, "stage0", True), ("x", 2, "stage1", True), ("x", 3, "topic", False), ("x", 4, "stage3", True), ("y", 1, "stage0", True), ("y", 2, "stage1", True)])
GATES = ("gate string, confirmed string", [("topic", "yes"), ("outline", "yes"), ("l4", "yes"), ("publish", "yes")])
HITS = ("group_idx int, result_idx int, perspective string, sub_dimension string, query string, title string, url string, snippet string", [
    (0, 0, "基础", "What", "减脂 是什么", "减脂是什么？ - 知乎", "https://www.zhihu.com/q/1", "减脂又称燃脂、刷脂"), (0, 1, "基础", "What", "减脂 是什么", "什么是减脂？", "https://www.sohu.com/a/1", ""),
    (0, 2, "基础", "What", "减脂 是什么", "到底减脂是什么？", "https://www.163.com/a/2", ""), (1, 0, "旅程", "瓶颈期", "减脂 平台期", "平台", "https://fit.example.com/p", "体重停滞也叫平台期，俗称卡秤"),
    (1, 1, "旅程", "瓶颈期", "减脂 平台期", "减脂平台期怎么突破？", "https://www.reddit.com/r/1", ""), (2, 0, "争议时效", "争议", "减脂 争议", "减肥药好不好？", "https://www.who.int/a", ""), (2, 1, "争议时效", "争议", "减脂 争议", "减肥药有哪些副作用？", "https://www.nhc.gov.cn/b", ""),
])
PAGES = ("url string, html string", [("https://fit.example.com/p", "<html><script>var a='减脂吗？';</script><h1>减脂平台期一般持续多久？</h1><p>很多人问。减脂期能不能喝酒？可以少量。</p><p>减脂期能不能喝酒？</p><h2>关于我们</h2></html>")])
PROBLEMS = ("question string, frequency long", [("平台期持续多久？", 5), ("减脂和减肥区别？", 3), ("减脂平台期怎么办？", 4), ("吃什么好？", 2), ("脂平台", 1)])
COVERED = ("question string", [("减脂平台期怎么办？",)])
BOUND = ("gate string, path string, sha256 string", [("outline", "/a", "h1"), ("l4", "/a", "h1"), ("l4", "/b", "old"), ("publish", "/a", "h1")])
BOUND_NOW = ("gate string, path string, sha256 string", [("outline", "/a", "h1"), ("l4", "/a", "h1"), ("l4", "/b", "h2"), ("publish", "/a", "h1"), ("publish", "/c", "h3")])
COPIES = ("name string, path string, sha256 string", [("x.py", "/1/x.py", "h"), ("x.py", "/2/x.py", "h"), ("y.py", "/1/y.py", "h"), ("y.py", "/2/y.py", "g")])
ASSETS = ("stage string, asset string, ok boolean", [("stage0", "library", True), ("stage1", "problems", True), ("stage3", "answers", True), ("stage4", "outlines", True), ("stage4", "gate", False)])
BACKFILLS = ("perspective string, sub_dimension string, round long, backfill boolean, found long", [("基础", "Why", 1, True, 0), ("基础", "Why", 2, True, 0), ("基础", "Who", 1, True, 0), ("基础", "Who", 2, True, 3), ("旅程", "认知期", 1, False, 0), ("旅程", "认知期", 2, True, 0)])
STATED = ("card string, confidence string", [("a", "高"), ("b", "高"), ("c", "中"), ("d", None), ("e", ""), ("g", "中")])
BROKEN = ("card string", [("a",), ("f",), ("f",)])
NOTES = ("note string, title string", [("讲平台期怎么破", "阳台种菜"), (None, "平台期"), ("番茄怎么种", None), ("种番茄", "番茄怎么种才甜"), (None, None)])
TOP = ["平台期", "番茄怎么种", "黄瓜怎么搭架", "怎么堆肥"]
TERMS = ("topic string, term string", [("种菜", "番茄"), ("种菜", "堆肥"), ("观鸟", "望远镜"), ("观鸟", "迁徙"), (None, "无题"), ("空", "")])
ASKED = ("idx long, topic string, text string", [(0, "种菜", "番茄几天浇一次水？"), (1, "种菜", "望远镜怎么选？"), (2, "观鸟", "望远镜怎么选？"), (3, "钓鱼", "减脂期能吃鱼吗？"), (4, None, "代餐贵吗？"), (5, "钓鱼", "鱼竿多长？"), (6, "观鸟", None), (7, None, "无题"), (8, "空", "瘦")])
PLANNED = ("article_id string, question string", [("a1", "q1"), ("a2", "q2"), ("a3", "q2"), ("a4", "q9")])
CHAPTERS = ("article_id string", [("a1",), ("a2",), ("a4",), ("zz",), ("a1",)])
ASKING = ("question string", [("q1",), ("q2",), ("q3",)])
FIELDS = ("article string, field string, value string", [("p", "答案", "有"), ("p", "反例", ""), ("p", "边界", None), ("q", "答案", "无")])
FIELD_SOURCES = ("article string, source_id string", [("p", "s1"), ("q", None), ("q", "s2")])
REFS = ("article string, section string, ref string", [("p", "1", "答案"), ("p", "1", "反例"), ("p", "2", "s1"), ("p", "2", "s2"), ("q", "1", "s2"), ("q", "2", "边界"), ("q", "2", None)])
PLAN = ("url string, action string, redundant_with string", [("https://zhuanlan.zhihu.com/p/1", "单页采集", None), ("https://docs.example.com/", "整站扒取", ""), ("https://example.org/a.pdf", "collector", "https://example.org/b"), ("https://book.douban.com/subject/1", "找电子版/购书", None), ("https://github.com/a/b", "单页采集", None)])
HOSTED = ("idx long, text string, site_host string", [
    (0, "见[甲](https://www.a.com/x \"t\")、[乙](https://b.org/y)、[](https://b.org/z)", "a.com"), (1, "见[甲](https://www.a.com/x)、[乙](https://docs.b.org/y)", "www.B.org"), (2, "[甲](https://a.com/x)[](u)", None),
    (3, "[甲](https://axcom/x)和[丙](//a.com/p)", "a.com"), (4, "[甲](https://c.net/a.com)", "a.com"), (5, "", "a.com"), (6, None, "a.com"),
])
LIBRARIES = ("tutorial string, topic string, material_ok boolean, coverage_gaps string", [("x", "种菜", True, ""), ("y", " ", True, ""), ("z", "观鸟", True, "迁徙"), ("w", "堆肥", None, ""), ("v", "钓鱼", True, "")])
ENTRIES = ("tutorial string, url string", [("x", "u1"), ("x", "u2"), ("y", "u1"), ("z", "u1"), ("w", "u1")])
LISTED = ("tutorial string, text string", [("x", "怎么种？"), ("x", "何时种？"), ("y", "看什么？"), ("z", "看什么？"), ("z", " "), ("w", None)])
ANSWERS = ("tutorial string, version long, state string, confidence string, question string", [("x", 3, "达标", "高", "q1"), ("x", 3, "达标", "中", "q2"), ("y", 3, "达标", "低", "q1"), ("z", 3, "达标", "高", "q1"), ("z", 3, "达标", "高", "q1"), ("w", None, "达标", "高", "q1"), ("u", 3, "达标", "高", "q1")])
FRESH = ("tutorial string, fresh boolean", [("x", True), ("y", True), ("z", True), ("w", True), ("u", False), ("v", True)])
ARTICLES = ("article string", [("p",), ("q",), ("r",), ("s",)])
BREAKS = ("article string, dimension string", [("p", "覆盖完整性"), ("p", "覆盖完整性"), ("q", "可执行性"), ("q", "可验证性"), ("r", "证据可靠性")])
STATES = ("article string, state string", [("p", "pass"), ("q", "fail"), ("s", "pass")])
STEPPED = ("article string", [("p",), ("q",), ("q",)])
CHECKERS = ("article string, checker string, fresh boolean", [("p", "tutorial", True), ("p", "render", True), ("q", "tutorial", False), ("q", "render", True), ("r", "tutorial", True), ("s", "tutorial", True), ("s", "render", True)])
GOOD_DIMS = ("article string, dimension string, status string", [(a, d, "pass" if (a, d) != ("p", "可验证性") else "not_verified") for a in ("p", "q", "r") for d in ("可执行性", "可验证性", "覆盖完整性", "证据可靠性")] + [("s", "可执行性", "not_applicable"), ("s", "可验证性", "pass"), ("s", "覆盖完整性", "pass"), ("s", "证据可靠性", "pass")])
REASONS = ("tutorial string, ord long, reason string", [("x", 2, "缺 大纲"), ("x", 1, "硬闸门未过：选题"), ("y", 1, "质检不通过"), ("z", 1, "别的事")])
LINKED = ("doc_id long, text string", [
    (1, "![图](img/a.png) [章](b.md#top) [外](https://a.com/c.md) [锚](#x) `[码](no.md)` [又](b.md?v=1)"), (2, "```\n[码](code.md)\n```\n[丁](./gone.md \"题\")"), (3, ""), (4, "[信](mailto:a@b.c) [根](//cdn/x.png) [空]()"),
])
PRESENT = ("path string", [("img/a.png",), ("x.md",)])
