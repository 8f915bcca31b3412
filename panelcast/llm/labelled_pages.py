"""The labelled table of the block classifier: small pages, main text under ``data-main``.

Each block of these pages is one training row.  The ``data-main`` mark is the
label only; it is no feature.
"""

PAGES = [
    # a news page: article element, menus, advert, footer; short and long paragraphs
    """<html><head><title>Harvest begins</title></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/world">World</a></li><li><a href="/sport">Sport</a></li></ul></nav>
<div class="ad">Buy two pairs of boots today and get the third one for half its price.</div>
<article data-main><h1>Harvest begins early in the valley</h1><p>The first trucks left the orchards before dawn.</p>
<p>Yes.</p><p>Farmers say that the warm spring brought the fruit forward by almost three weeks, which nobody in the
cooperative had expected when they met in winter to plan the work, hire the pickers and book the lorries.</p>
<p>It was <a href="/w">warm</a>.</p></article>
<footer>&copy; Valley Post. All rights reserved. Printed on recycled paper in the old mill by the river.</footer></body></html>""",
    # article with an aside, an advert and reader comments inside it
    """<body><header><p>Valley Post, a daily paper for everyone who lives between the two rivers and the sea.</p></header>
<main><article><div data-main><h2>The bridge</h2><p>Work on the bridge starts on Monday.</p><p>Cars must go around by the
north road until the end of May, the council said on Thursday evening.</p></div>
<aside><p>More about roads in our big summer special, which is out now at every kiosk in town.</p></aside>
<div class="advert"><p>Cheap tyres for all cars, fitted while you wait at the station.</p></div>
<div data-main><p>Buses keep to their times.</p><ul><li>Line one</li><li>Line four by night</li></ul></div>
<section class="comments"><h3>Comments</h3><p>I think that this bridge should have been closed ten years ago already.</p>
<p>Nonsense.</p></section></article></main><footer><p>Contact</p></footer></body>""",
    # no article element: content class, sidebar, cookie notice, share links
    """<body><div id="cookie-notice">We use cookies to make this site better for you. <button>Accept</button></div>
<div class="menu"><a href="/a">Recipes</a> <a href="/b">Wine</a></div>
<div class="post-content" data-main><h1>Bean soup</h1><p>Soak the beans overnight in plenty of cold water.</p><p>Drain them.</p>
<p>Cook them slowly with an onion, two bay leaves and a spoon of oil until they are soft, about an hour and a half.</p></div>
<div class="sidebar"><h4>Popular</h4><p>Ten soups for cold evenings that you can cook in half an hour.</p></div>
<div class="share"><a href="#">Share</a></div></body>""",
    # plain page without any hints: long blocks are text, link lists and short scraps are not
    """<body><table><tr><td><a href="1">Start</a> | <a href="2">Links</a> | <a href="3">Guest book</a></td></tr></table>
<p data-main>My grandfather built the boat in the winter of 1952, in a shed that was barely longer than the boat itself, and
when spring came they had to take the wall down to get it out.</p>
<p data-main>He sailed it for thirty years along the coast and twice over to the islands, always in June, when the nights are
short and the wind comes steadily from the west.</p>
<p data-main>It still lies in the harbour.</p>
<p data-main>Every summer we paint it, and every summer somebody on the quay asks us whether it is for sale, which it is not.</p>
<p><a href="next">Next page</a></p><p><a href="1">Back to the start page</a> <a href="m">Write me</a></p>
<p>Last changed in May 2003.</p><p>Visitor 10233</p></body>""",
    # plain page, scraps among links at either end
    """<body><p>The boat pages</p><p><a href="1">Sails</a> <a href="2">Ropes</a></p><p>You are here:</p><p><a href="k">Knots</a></p>
<p data-main>A good knot holds under load, does not slip when the rope is wet, and can still be opened with cold hands.</p>
<p data-main>The bowline does all three.</p>
<p data-main>Learn to tie it behind your back and with one hand, because the day you need it you will have no other.</p>
<p><a href="s">Splices</a></p><p>Best seen at 800 by 600.</p><p><a href="g">Guest book</a></p><p>Made on an old computer.</p></body>""",
    # forms and notices around an article that is one short line
    """<body><form><p>Sign in with your name and password to read the newspaper on all your devices.</p></form>
<article data-main><p>Closed today.</p></article>
<div class="newsletter"><p>Get our letter every Friday, with the best stories of the week and a crossword.</p></div>
<div role="alert"><p>Your browser is out of date and may not show this page as it should.</p></div></body>""",
    # article with many links and lists, which stay
    """<body><nav><a href="/">Index</a></nav><article data-main><h1>Further reading</h1>
<ul><li><a href="a">A history of the harbour</a></li><li><a href="b">Boats and their builders</a></li></ul>
<p><a href="c">The shed</a></p><p>All of these can be borrowed from the town library, which is open on weekdays.</p></article>
<footer><a href="i">Imprint</a></footer></body>""",
    # main element without article, breadcrumbs and related stories inside
    """<body><div class="topbar"><p>Welcome back, dear reader, there are three new messages for you.</p></div>
<main><div class="breadcrumbs"><a href="/">Home</a> <a href="/n">Nature</a></div><div data-main><h1>Owls</h1><p>Owls hunt by night.</p><p>They fly
without a sound because of the soft fringe on their feathers, and they hear a mouse under the snow.</p></div>
<div class="related"><p>Why bats sleep upside down, and what they do when winter comes.</p></div></main>
<div id="footer"><p>Text and pictures may be used with the name of the author.</p></div></body>""",
    # no article: header and footer elements, body text in bare paragraphs with short ones between
    """<body><header><h1>Notes of a gardener</h1><p>Plain words about plants, weather and soil, every week.</p></header>
<p data-main>This week the tomatoes went out into the beds, which is early, but the nights have been mild and the soil is warm.</p>
<p data-main>We shall see.</p>
<p data-main>If frost comes after all I shall cover them with old sheets, as my neighbour does with everything she grows.</p>
<footer><p>Written by hand and typed up on Sundays; letters are always welcome at the address above.</p></footer></body>""",
    # a content class over short lines only
    """<body><nav><a href="/">Poems</a></nav><div class="story" data-main><h2>Three answers</h2><p>No.</p><p>Yes.</p>
<p>Perhaps so.</p><p>Ask again when the snow has gone</p><p>Then wait.</p></div><p>Printed by hand.</p><footer><p>Imprint</p></footer></body>""",
    # content hint by id; advert and comments by id
    """<body><div id="banner"><p>Our spring sale ends on Sunday, so come by while there is still something left.</p></div>
<div id="content"><div data-main><h2>Timetable</h2><p>The ferry leaves at six.</p><p>It does not sail in storms.</p></div>
<div id="comments"><p>Does anybody know if they take bicycles on the first boat in the morning?</p></div></div></body>""",
    # hints of the layout on the page and on the article's frame, an icon without an end tag in the text
    """<html class="no-js has-ads"><body class="has-sidebar menu"><nav><a href="/">Mills</a></nav><div class="content with-sidebar" data-main>
<h1>The mill</h1><p>The mill stands <svg width="8"/>by the weir.</p><p>It still grinds <object data="x">on two days of the week.</p></div>
<div class="sidebar"><p>Other mills that you can visit on foot from the station in the valley.</p></div></body></html>""",
]
