"""Pages with marked main text, from which `html_extract` learns.

Written for this module after common layouts of the web. M12 stands for twelve words of main text, S12 for twelve other words.
"""

from __future__ import annotations

import re

PAGES = [
    # A blog engine with widgets and nested comments.
    """<html><head><title>S4</title><style>S9</style></head><body class="home blog"><div id="page" class="hfeed site"><header id="masthead" class="site-header"><div class="site-branding"><h1 class="site-title"><a href="/">S2</a></h1><p class="site-description">S6</p></div>
<nav id="site-navigation" class="main-navigation"><ul class="menu"><li class="menu-item"><a href="/a">S1</a></li><li class="menu-item"><a href="/b">S2</a></li></ul></nav></header>
<div id="content" class="site-content"><div id="primary" class="content-area"><main id="main" class="site-main"><article id="post-7" class="post hentry"><header class="entry-header"><h1 class="entry-title">M6</h1><div class="entry-meta"><span class="posted-on">S3 <time>S3</time></span><span class="byline">S1 <a>S2</a></span></div></header>
<div class="entry-content"><p>M30</p><p>M25 <a href="/x">M3</a> M12</p><h2>M4</h2><p>M40 <em>M2</em> M8 <strong>M2</strong></p><ul><li>M8</li><li>M9 <a href="/y">M2</a></li></ul><blockquote><p>M15</p></blockquote><figure class="wp-caption"><img src="a.jpg"><figcaption>M7</figcaption></figure><div class="sharedaddy"><h3 class="share-title">S2</h3><ul><li class="share-facebook"><a>S1</a></li></ul></div></div>
<footer class="entry-footer"><span class="cat-links">S2 <a>S1</a></span><span class="tags-links"><a>S2</a></span></footer></article>
<nav class="navigation post-navigation"><div class="nav-links"><div class="nav-previous"><a>S4</a></div></div></nav>
<div id="comments" class="comments-area"><h2 class="comments-title">S4</h2><ol class="comment-list"><li class="comment even"><article class="comment-body"><footer class="comment-meta"><b class="fn">S2</b></footer><div class="comment-content"><p>S25</p></div></article></li></ol><div id="respond" class="comment-respond"><h3>S3</h3><form class="comment-form"><p class="comment-notes">S8</p><label>S1</label><textarea>S1</textarea></form></div></div></main></div>
<aside id="secondary" class="widget-area sidebar"><section class="widget widget_recent_entries"><h2 class="widget-title">S2</h2><ul><li><a>S5</a></li></ul></section><div class="widget widget_text"><p>S20</p></div></aside></div>
<footer id="colophon" class="site-footer"><div class="site-info"><p>S8 <a>S2</a></p></div></footer></div><script>S9</script></body></html>""",
    # A newspaper.
    """<body><div class="cookie-banner" role="dialog"><p>S18</p><button>S1</button></div><div class="topbar"><span>S3</span><a>S1</a></div><header role="banner"><div class="logo"><a>S2</a></div><form role="search" class="search"><input name="q"><button>S1</button></form></header><nav role="navigation"><a>S1</a> <a>S1</a> <a>S2</a></nav>
<div class="breaking-news"><a>S6</a></div><div class="container"><div class="row"><div class="col-md-8"><article class="story"><h1 class="headline">M9</h1><p class="standfirst">M18</p><p class="author">S3</p><div class="dateline">S4</div><div class="story-body"><p>M35</p><div class="advert"><p>S2</p><div id="ad-slot-1">S12</div></div><p>M42</p>
<aside class="pullout"><h3>S2</h3><ul><li><a>S7</a></li><li><a>S6</a></li></ul></aside><p>M28 <a>M2</a> M10</p><div class="newsletter-signup"><h3>S4</h3><p>S12</p><form><label>S2</label><input><button>S1</button></form></div><h3>M4</h3><p>M33</p><table><thead><tr><th>M2</th><th>M1</th></tr></thead><tbody><tr><td>M4</td><td>M2</td></tr></tbody></table><p><i>M7</i></p></div>
<div class="social-share"><span>S2</span><a>S1</a><a>S1</a></div><div class="tags"><a>S1</a><a>S2</a></div></article><section class="related-stories"><h2>S2</h2><div class="card"><a><h3>S8</h3></a><p>S16</p></div></section><section id="disqus_thread" class="comments"><h2>S1</h2><div class="comment"><p>S30</p></div><table class="comment"><tr><td>S2</td><td>S22</td></tr></table></section></div>
<div class="col-md-4"><div class="sidebar"><div class="most-read"><h4>S2</h4><ol><li><a>S7</a></li></ol></div><div class="promo"><p>S14</p></div><div class="sponsored"><span>S1</span><p>S11</p></div></div></div></div></div>
<footer><div class="footer-links"><ul><li><a>S2</a></li></ul></div><p class="copyright">S9</p><p class="legal">S20</p></footer></body>""",
    # Plain pages without any class.
    "<body><header><h1>S2</h1><p>S5</p></header><nav><ul><li><a>S1</a></li><li><a>S1</a></li></ul></nav><article><h1>M5</h1><p>M20</p><p>M3</p><p><b>M12<br>M18</b></p><p><a>M6</a></p><ol><li>M5</li><li><p>M9</p></li></ol></article><aside><p>S15</p></aside><footer>S6 S8</footer></body>",
    "<body><nav><a>S1</a><a>S1</a></nav><main><h1>M4</h1><p>M25</p><h2>M3</h2><p>M25</p><pre><code>M12</code></pre><dl><dt>M2</dt><dd>M9</dd></dl><aside><p>S14</p></aside><form><p>S8</p><fieldset><legend>S2</legend><label>S2</label><select><option>S1</option></select></fieldset></form><p>M14</p></main><footer><p>S9</p></footer></body>",
    "<h1>M4</h1><p>M22</p><p>M18 <a>M2</a></p>",
    "<p>M3</p>",
    "<section><h2>M4</h2><p>M22</p></section>",
    "<body><main><header><h1>M5</h1><p>S4</p></header><p>M25</p><section><header><h2>M3</h2></header><p>M20</p></section><footer><p>S5</p></footer></main><footer><p>S5</p></footer></body>",
    "<body><section><h1>M3</h1><p>M30</p></section><section><h2>M3</h2><p>M20</p></section></body>",
    "M25",
    "<div>M30</div><div>M12<br>M9</div>",
    "<p>M8</p><ul><li>M5</li><li>M4</li></ul><table><tr><td>M3</td><td>M2</td></tr></table><p>M9</p>",
    "<body><article><header><h1>M5</h1><p>S3</p><address>S4</address></header><p>M18</p><section><h2>M3</h2><p>M21</p><footer><p>S6</p></footer></section><footer><p>S7</p><nav><a>S2</a></nav></footer></article></body>",
    "<body><article><header><h2>M5</h2><div><span>S2</span> <time>S3</time></div></header><div><p>M18</p><div><p>M12</p></div></div><dialog><p>S9</p></dialog><menu><li>S2</li></menu></article></body>",
    # Old layouts of tables and fonts.
    """<body bgcolor="white"><table width="100%"><tr><td id="header" colspan="3"><font size="5">S3</font></td></tr><tr><td id="leftnav" class="menu"><a>S1</a><br><a>S2</a><br></td><td id="content"><h2>M5</h2><p>M30</p><p>M26</p><font>M14</font></td><td class="rightcol"><p>S12</p></td></tr><tr><td class="bottom footer"><center><font size="1">S10</font></center></td></tr></table></body>""",
    # A forum.
    """<body><div id="header"><h1><a>S2</a></h1><div class="userbar login"><a>S1</a> <a>S1</a></div></div><div class="breadcrumbs"><a>S1</a> &gt; <a>S2</a></div><div id="posts" class="content"><div class="article text"><h2>M6</h2><p>M35</p><p>M20</p></div><div class="replies"><div class="reply"><div class="author">S1</div><p>S28</p></div><div class="reply"><p>S19</p></div></div></div><div class="pagination"><a>S1</a><a>S1</a></div><div id="footer"><p>S7</p></div></body>""",
    # Documentation.
    """<body><div class="navbar"><div class="navbar-inner"><a class="brand">S1</a><ul class="nav"><li><a>S1</a></li></ul></div></div><div class="document"><div class="sphinxsidebar"><h3>S2</h3><ul><li><a>S3</a></li></ul><div class="searchbox"><form><input></form></div></div><div class="documentwrapper"><div class="body" role="main"><section id="introduction"><h1>M3<a class="headerlink">S1</a></h1><p>M26</p><div class="highlight"><pre>M14</pre></div><ul class="simple"><li><p>M8</p></li></ul><div class="admonition tip"><p>M9</p></div></section></div></div></div><div class="related" role="navigation"><ul><li><a>S2</a></li></ul></div><div class="footer" role="contentinfo">S9</div></body>""",
    # A wiki.
    """<body><div id="mw-page-base"></div><div id="siteNotice" class="notice"><p>S12</p></div><div id="content" class="mw-body" role="main"><h1 id="firstHeading">M3</h1><div id="bodyContent"><div id="toc" class="toc"><ul><li><a>S2</a></li></ul></div><p>M45 <a>M2</a> M10 <sup class="reference"><a>S1</a></sup></p><h2><span class="mw-headline">M2</span><span class="editsection"><a>S1</a></span></h2><p>M38</p><div class="thumb"><div class="thumbcaption">M8</div></div></div></div><div id="mw-panel" role="complementary"><div class="portal" role="navigation"><h3>S1</h3><ul><li><a>S2</a></li></ul></div></div><div id="footer" role="contentinfo"><ul><li>S8</li><li><a>S2</a></li></ul></div></body>""",
    # A landing page of a shop's magazine.
    """<body><div class="announcement notice"><span>S7</span></div><div class="popup modal overlay"><h2>S4</h2><p>S12</p><a class="close">S1</a></div><div class="header-wrapper"><div class="menu-main"><a>S1</a><a>S1</a></div></div><section class="hero banner"><h2>S4</h2><p>S8</p></section><div class="article-body post-body"><h1>M6</h1><p>M28</p><div class="banner-inline"><p>S8</p></div><h3>M3</h3><p>M31</p><div class="ad">S10</div><p>M4</p><div class="product-promo related"><p>S9</p></div><p>M22</p></div><div class="author-bio"><p>S15</p></div><div class="you-may-like recommended"><h4>S3</h4><div class="item"><a>S6</a></div></div><div id="reviews" class="user-comments"><ul class="commentlist"><li><p>S21</p></li></ul></div><div class="subscribe"><p>S9</p></div><div class="foot"><p>S8</p></div></body>""",
    # A magazine with hashed class names.
    """<body><div id="root"><div class="a1 b2"><div class="c3"><a>S1</a><a>S2</a></div></div><div role="alert" class="x9"><p>S10</p></div><main><div class="d4"><article><div class="e5"><h1>M6</h1></div><div class="f6"><div><p>M30</p></div><div><p>M25</p></div><div role="complementary"><p>S9</p></div><div><p>M25 <span>M2</span></p></div></div></article></div></main><div role="contentinfo"><p>S9</p></div></div></body>""",
    # Government and university pages.
    """<body><a class="skip" href="#main">S3</a><div id="global-cookie-message" class="gdpr consent"><p>S16</p></div><div id="wrapper"><div id="masthead"><p>S4</p></div><ol class="breadcrumb"><li><a>S1</a></li><li>S2</li></ol><div id="main-content" class="main content"><h1>M4</h1><div class="intro lead"><p>M16</p></div><p>M27</p><h2>M3</h2><ol><li>M8</li><li>M7</li></ol><div class="contact-form"><form><div><label>S2</label></div><p>S7</p></form></div><p>M13</p></div><div id="subnav" class="local-nav"><ul><li><a>S3</a></li></ul></div><div class="page-footer"><p>S6</p><ul class="legal-links"><li><a>S2</a></li></ul></div></div></body>""",
    """<body><div class="page"><div class="masthead"><h1>S3</h1></div><div class="text-block main-text"><h2>M4</h2><p>M24</p><blockquote>M12<cite>M2</cite></blockquote><p>M18</p></div><div class="links related-links"><p>S4</p><ul><li><a>S5</a></li></ul></div><div class="disclaimer"><p>S20</p></div><div class="footer-bottom"><p>S6</p></div></div></body>""",
    # A hosted blog.
    """<body class="loading"><div class="body-fauxcolumns"></div><div class="content"><div class="content-outer"><div class="main section" id="main"><div class="widget Blog"><div class="blog-posts hfeed"><h2 class="date-header"><span>S3</span></h2><div class="post-outer"><div class="post hentry"><h3 class="post-title entry-title">M5</h3><div class="post-body entry-content"><div>M30</div><div>M20<br>M15</div><p>M9</p></div><div class="post-footer"><span class="post-author">S2</span><span class="post-labels"><a>S1</a></span></div></div><div class="comments" id="comments"><h4>S2</h4><dl id="comments-block"><dt class="comment-author">S2</dt><dd class="comment-body"><p>S22</p></dd></dl></div></div></div></div></div><div class="sidebar section"><div class="widget Profile"><h2>S1</h2><p>S9</p></div></div></div></div></body>""",
    # Notes, menus and adverts as elements of an article.
    """<body><article class="article text story entry"><h1>M5</h1><div class="byline">S3</div><p>M20</p><div class="ads sponsor">S10</div><div class="notice"><p>S9</p></div><div class="sidebar"><p>S12</p></div><nav><ul><li><a>S2</a></li></ul></nav><section class="widget"><p>S8</p></section><p>M20</p><div class="menu"><span>S2</span></div><div class="toolbar"><span>S2</span></div><div class="share social"><span>S2</span></div><form><p>S6</p></form><footer><p>S5</p></footer><table class="comments"><tr><td>S9</td></tr></table><ul class="comments"><li>S12</li></ul><div class="responses discussion"><p>S12</p></div><section class="comments"><h3>S1</h3><p>S12</p></section><p>M11</p></article></body>""",
    """<body><div class="header"><div>S3</div><ul><li>S1</li></ul></div><div class="nav"><ul><li>S1</li></ul></div><div id="content"><div class="post"><h1>M4</h1><p>M25</p><div class="advertisement"><span>S9</span></div><p>M25</p></div><div id="comments"><div><p>S14</p></div></div></div><div id="sidebar"><div><p>S18</p></div></div><div class="footer"><div><p>S9</p></div></div></body>""",
    """<body><section class="page-header"><h1>S3</h1></section><section class="content"><h2>M4</h2><p>M25</p><p>M21</p></section><section class="comments-section"><p>S18</p></section><section id="footer"><p>S7</p></section><div class="cookie"><p>S10</p></div><div class="cookies consent-popup"><span>S10</span></div></body>""",
]


def rendered() -> list[str]:
    """The pages with `main` and `side` for their words."""
    words = {"M": "main", "S": "side"}
    return [re.sub(r"\b([MS])(\d+)\b", lambda m: " ".join([words[m[1]]] * int(m[2])), page) for page in PAGES]
