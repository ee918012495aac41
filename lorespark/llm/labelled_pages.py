"""Labelled pages from which the content model is trained: at most the blocks that stand here.

A page is a list of (mark, block). `+` is content, `~` is rendered but no content of the page
(navigation, notices, boxes, categories, tables of contents), `-` is hidden or quoted (comments,
nowiki, scripts). The mark holds for all nodes of a block; what looks like markup inside a comment,
nowiki or code block is hidden whatever the mark.
"""

PAGES = [
    [("~", "{{Infobox tool\n| name = Axe\n| cost = 200\n}}"), ("+", "== Use =="), ("+", "The axe fells trees and splits stumps on the farm."), ("+", "* Fells oak\n* Fells pine\n** Only when upgraded"), ("~", "[[Category:Tools]]")],
    [("-", "<!-- == Old notes ==\n* to be removed -->"), ("+", "Rain falls more often in spring than in any other season of the year."), ("+", "<pre>\nprint(day)\n* not a list\n== neither ==\n</pre>"), ("~", "[[de:Regen]]"), ("~", "[[Category:Weather]]")],
    [("+", "<h2>Gifts</h2>"), ("+", "<p>Most people like a gift that was made by hand.</p>"), ("+", "<ul>\n<li>Jam</li>\n<li>Honey</li>\n</ul>"), ("-", "<nowiki>* shown as it is</nowiki>")],
    [("+", "\\section{Speed}"), ("+", "A horse moves faster than a walker, as $v = 2 w$ states for any road."), ("+", "\\begin{itemize}\n\\item Walk\n\\item Ride\n\\end{itemize}"), ("+", "\\begin{equation}\nv = s / t\n\\end{equation}")],
    [("+", "Fishing\n-------"), ("+", "- Rod\n- Bait\n  - Worm"), ("+", "```\ncast(rod)\n# wait\n- reel\n$x$\n```"), ("+", "### Places ###"), ("+", "The lake has trout all year, the river only when the snow melts.")],
    [("~", "{{Stub}}"), ("+", "This page about [[Ore|ore]] is short and wants more text."), ("~", "[[Category:Short pages]]")],
    [("+", "{| class=\"wikitable\"\n! Name !! Price\n|-\n| [[Jam]]\n| 40\n|}"), ("+", "=== History ==="), ("+", "# First version\n# Second version"), ("~", "[[fr:Prix]]")],
    [("-", "<nowiki>== Not a title ==</nowiki>"), ("~", "{{Navbox|list=fish}}"), ("+", "== Fish =="), ("+", "All fish sell for more when the quality is gold or better."), ("+", "$$p = 1.5 q$$"), ("~", "[[分类:Fish]]")],
    [("+", "<gallery>\nFile:A.png|first\nFile:B.png|second\n</gallery>"), ("+", "[[File:Axe.png|thumb|An axe]]"), ("+", "A short caption."), ("-", "<!-- [[Slot]] {{Gone}} \\section{Gone} $a$ -->"), ("+", "<source lang=lua>\nreturn 1\n## no title\n</source>")],
    [("+", "== 历史 =="), ("+", "这个村庄在很久以前由渔民建立。"), ("+", "* 第一项\n* 第二项"), ("~", "{{模板|名=值}}"), ("~", "[[分类:村庄]]")],
    [("+", "1. Dig\n2. Sow\n3. Water"), ("+", "~~~\nplot.dig()\n* star\n~~~"), ("+", "\\begin{verbatim}\nplot.sow()\n\\section{no}\n\\end{verbatim}"), ("~", "{{Reflist}}")],
    [("~", "{{Quote|Be kind.}}"), ("+", "Players often ask how long a crop takes; \\(t = 4\\) days is usual."), ("+", "<math>t = 4</math>"), ("~", "[[ja:Sakumotsu]]"), ("~", "[[category: Crops|*]]")],
    [("~", "<div class=\"navbox\">\n<ul>\n<li>[[Home]]</li>\n<li>[[Maps]]</li>\n<li>[[Shops]]</li>\n</ul>\n</div>"), ("+", "<h2>The mill</h2>"), ("+", "<p>The mill grinds wheat into flour within an hour.</p>"), ("~", "<footer><p>Copyright 2021. All rights reserved.</p></footer>")],
    [("~", "<nav><a href=\"/wiki/Home\">Home</a> <a href=\"/wiki/Help\">Help</a></nav>"), ("-", "<script>var t = 1; track(t);</script>"), ("+", "<div class=\"main\">\n<p>Bees make honey while flowers are open, and rest in winter.</p>\n</div>"), ("-", "<style>.a { color: red }</style>")],
    [("~", "Jump to: navigation, search"), ("+", "Sheep give wool every third day if they are petted."), ("+", "== Wool =="), ("+", "* [[Cloth]] is woven from it\n* Dyed with [[Beet]]"), ("~", "Retrieved from the old wiki")],
    [("~", "<div id=\"toc\" class=\"toc\"><ol><li>Contents</li><li>Use</li><li>History</li></ol></div>"), ("+", "<h3>Use</h3>"), ("+", "<ol>\n<li>Light the fire</li>\n<li>Cook the fish</li>\n</ol>"), ("+", "<table><tr><th>Fish</th><th>Price</th></tr><tr><td>Carp</td><td>30</td></tr></table>")],
    [("~", "<div class=\"cookie-banner\">We use cookies. <a href=\"/privacy\">Privacy policy</a></div>"), ("+", "<div>\\[x = y + 1\\]</div>"), ("+", "Costs rise with every level, as the table above shows."), ("~", "<div class=\"share\">Share on <a href=\"/f\">one</a> <a href=\"/t\">two</a></div>")],
    [("~", "* [[Home]]\n* [[Log in]]\n* [[Help]]\n* [[Contact us]]"), ("+", "== Bread =="), ("+", "Bread is baked from flour and sold at the inn for sixty coins."), ("+", "# Grind\n# Knead\n## Twice\n# Bake")],
    [("+", "## 用法\n"), ("+", "旧桥在早晨开放，商人从那里进城。"), ("+", "- 铁锤\n- 木梯"), ("~", "版权所有，保留所有权利。"), ("~", "跳转到：导航、搜索")],
    [("+", "\\subsection*{Harvest}"), ("+", "\\begin{enumerate}\n\\item Cut\n\\item Bind\n\\end{enumerate}"), ("+", "\\begin{lstlisting}\nrun(1)\n* no item\n\\end{lstlisting}"), ("-", "% \\section{Left out}")],
    [("~", "{{Hatnote|For the town see [[Town]].}}"), ("+", "[[Plum]]s ripen late; [[Pear]]s do so earlier and [[Apple]]s last."), ("+", "* [[Plum]]\n* [[Pear]]\n* [[Apple]] jam"), ("~", "{{#invoke:Fruit|list}}"), ("~", "[[Category:Fruit]] [[Category:Trees]]")],
    [("~", "<div class=\"sidebar\"><p>Subscribe to our newsletter</p><ul><li><a href=\"/a\">Latest posts</a></li></ul></div>"), ("+", "<p>The lamp burns oil from the third press.</p>"), ("+", "<pre><code>oil = press(3)\n# no title</code></pre>"), ("~", "<p class=\"edit\">Edit this page | View history</p>")],
    [("+", "Moon\n===="), ("+", "Tides turn when the moon is full."), ("+", "<syntaxhighlight lang=\"py\">\nturn()\n* no\n</syntaxhighlight>"), ("~", "Back to top"), ("-", "<!-- <ul><li>gone</li></ul> -->")],
    [("~", "<header><div class=\"menu\"><a href=\"/1\">Shop</a><a href=\"/2\">Forum</a></div></header>"), ("+", "<h4>Rope</h4>"), ("+", "<p>Rope is made of <a href=\"/wiki/Fiber\">fiber</a> and holds a boat.</p>"), ("~", "<div class=\"noprint metadata\">This article is a draft. You can help by editing it.</div>")],
    [("+", "== Bridges =="), ("-", "<!-- == Gone ==\n* gone\n{{Gone}} -->"), ("+", "=== Stone ==="), ("-", "<nowiki>* star\n== no ==</nowiki>"), ("+", "==== Wood ===="), ("~", "{{Gate box\n| name = Oak\n}}"), ("+", "<h2>Rope</h2>"), ("-", "<!-- <h2>Gone</h2> <ul><li>gone</li></ul> -->")],
    [("+", "== Code =="), ("+", "```\nlocal a = 1\n* star\n# step\n* star\n# step\n- dash\n```"), ("+", "<pre>\n* one\n* two\n* three\n\n== four ==\n\n- five\n- six\n$x$ and $y$\n</pre>"), ("~", "[[de:Kode]]")],
    [("+", "<source lang=lua>if a < b then\n== 7 ==\n* star 2\n* star 3\n* star 4\n# step\n# step</source>"), ("-", "<!--\n* a\n* b\n* c\n* d\n\n== e ==\n\ntext that was taken out\n-->"), ("-", "<nowiki>\n# one\n# two\n# three\n</nowiki>"), ("+", "Fine flour is sold in the morning.")],
    [("+", "\\section{Notes}"), ("-", "% \\section{No} \\item no"), ("+", "\\subsection{Empty}"), ("-", "<!-- $a$ \\[b\\] -->"), ("+", "\\begin{verbatim}\n\\item a\n\\item b\n\\item c\n\\end{verbatim}"), ("~", "[[Category:Notes]]")],
    [("+", "## Tools"), ("~", "{{Stub}}"), ("+", "## Seeds"), ("~", "[[Category:Seeds]]")],
]
